"""Token ids on disk, compressed by a Re-Pair grammar per shard.

The ids of a shard's documents form one sequence. Frequent neighbouring pairs
are replaced by new symbols, round after round; a pair that would reach over the
end of a document is left alone. A shard keeps the rules, the number of ids each
symbol stands for, the sequence and where each document begins, so any document,
or any id of one, is decoded without the rest.

Blob, little-endian: ``RPG1``, uint32 base, rules, symbols, documents; uint16
pairs of the rules; uint32 expansion length of every rule; uint32 first symbol
of every document and the end; uint16 symbols.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import documents, id_and_text, slices
from tablewright.llm.tokens import WordIds, crc_of_ids, public_path
from tablewright.session import map_arrow, scratch_path

END_ID = 2
BASE = 49_408  # terminals of the vocabulary; rules follow, all below 65,536
SHARD_IDS = 1 << 20
LEAST = 5  # a rule takes 8 bytes, each use of it saves 2
SHARE = 4  # a round gives out one part in so many of the symbols, the most frequent pairs first
BUCKETS = 17  # bits
MAGIC = b"RPG1"


def frequent_pairs(key: np.ndarray, least: int, most: int) -> np.ndarray:
    """Up to ``most`` of the pairs that occur ``least`` times or more, the most frequent first."""
    key = np.sort(key)
    begin = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(begin, len(key)))
    often = count >= least
    begin, count = begin[often], count[often]
    return key[begin[np.argsort(-count, kind="stable")[:most]]]


def compress(ids: np.ndarray, ends: np.ndarray, base: int = BASE, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first symbol of every document and the end, rules [n, 2]).

    ``ends``: end of every document in ``ids``. Each round counts all pairs and
    gives the most frequent ones a symbol; where they overlap, every second one of
    a run is replaced. Rounds end when no pair occurs ``least`` times or the
    symbols have run out. Two chosen pairs that share a bucket of the lookup take
    turns: the rarer one waits for the next round.
    """
    if len(ids) and int(ids.max()) >= base:
        raise ValueError(f"id {int(ids.max())} is outside the {base} terminals")
    seq = ids.astype(np.uint16)
    last = np.zeros(len(seq), bool)  # symbol that ends its document
    last[ends[ends > 0] - 1] = True
    begins = np.append(0, ends[:-1]) if len(ends) else ends
    first = np.zeros(len(seq) + 1, np.int64)  # documents that begin at a position
    np.add.at(first, begins, 1)
    rules: list[np.ndarray] = []
    symbols = (1 << 16) - base
    free = symbols
    while len(seq) > 1 and free > 0:
        key = seq[:-1].astype(np.uint32) << np.uint32(16) | seq[1:]
        open_ = ~last[:-1]
        chosen = frequent_pairs(key[open_], least, min(free, max(1, symbols // SHARE)))
        if not len(chosen):
            break
        bucket = lambda k: (k * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKETS)
        held, number = np.zeros(1 << BUCKETS, np.uint32), np.full(1 << BUCKETS, -1, np.int32)
        slot = bucket(chosen)
        held[slot[::-1]], number[slot[::-1]] = chosen[::-1], np.arange(len(chosen))[::-1]  # the most frequent stays
        slot = bucket(key)
        new = np.where(open_ & (held[slot] == key), number[slot], -1)
        at = np.flatnonzero(new >= 0)
        run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        at = at[(at - np.repeat(at[run], np.diff(np.append(run, len(at))))) % 2 == 0]
        used = np.bincount(new[at], minlength=len(chosen)) > 0
        rules.append(np.stack([chosen[used] >> np.uint32(16), chosen[used] & np.uint32(0xFFFF)], 1))
        seq[at] = (base + symbols - free + np.cumsum(used) - 1)[new[at]]
        free -= int(used.sum())
        last[at] = last[at + 1]
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq, last = seq[keep], last[keep]
        first = first[np.append(keep, True)]  # no document begins inside a replaced pair
    table = np.concatenate(rules).astype(np.int32) if rules else np.zeros((0, 2), np.int32)
    bounds = np.append(np.repeat(np.arange(len(seq) + 1), first), len(seq))
    return seq, bounds, table


def lengths_of(rules: np.ndarray, base: int = BASE) -> np.ndarray:
    """Ids that each rule stands for; a rule only uses earlier ones."""
    out = np.ones(base + len(rules), np.int64)
    at = 0
    while at < len(rules):
        # all rules whose parts are known form one step
        ready = int(np.argmax(rules[at:].max(1) >= base + at)) if (rules[at:].max(1) >= base + at).any() else len(rules) - at
        out[base + at : base + at + ready] = out[rules[at : at + ready, 0]] + out[rules[at : at + ready, 1]]
        at += ready
    return out[base:]


def expand(seq: np.ndarray, rules: np.ndarray, base: int = BASE) -> np.ndarray:
    seq = seq.astype(np.int64)
    while True:
        inner = seq >= base
        if not inner.any():
            return seq.astype(np.uint32)
        times = 1 + inner
        second = np.cumsum(times)[inner] - 1
        pairs = rules[seq[inner] - base]
        seq = np.repeat(seq, times)
        seq[second - 1], seq[second] = pairs[:, 0], pairs[:, 1]


def pack(ids: np.ndarray, ends: np.ndarray) -> bytes:
    seq, bounds, rules = compress(ids, ends)
    return b"".join([
        MAGIC, struct.pack("<4I", BASE, len(rules), len(seq), len(ends)), rules.astype("<u2").tobytes(),
        lengths_of(rules).astype("<u4").tobytes(), bounds.astype("<u4").tobytes(), seq.astype("<u2").tobytes(),
    ])


class Shard:
    """Random access to the documents of one blob."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a shard of token ids")
        self.base, n_rules, n_symbols, self.n = struct.unpack_from("<4I", blob, 4)
        at = 20
        parts = []
        for kind, n in (("<u2", 2 * n_rules), ("<u4", n_rules), ("<u4", self.n + 1), ("<u2", n_symbols)):
            parts.append(np.frombuffer(blob, kind, n, at))
            at += parts[-1].nbytes
        self.rules, self.lengths, self.bounds, self.symbols = parts[0].reshape(-1, 2).astype(np.int64), *parts[1:]

    def document(self, i: int) -> np.ndarray:
        return expand(self.symbols[self.bounds[i] : self.bounds[i + 1]], self.rules, self.base)

    def documents(self) -> list[np.ndarray]:
        """All documents, expanded together."""
        own = np.ones(len(self.symbols) + 1, np.int64)
        inner = np.flatnonzero(self.symbols >= self.base)
        own[inner] = self.lengths[self.symbols[inner].astype(np.int64) - self.base]
        ends = np.cumsum(own) - own
        ids = expand(self.symbols, self.rules, self.base)
        at = ends[self.bounds]
        return [ids[at[i] : at[i + 1]] for i in range(self.n)]

    def slice(self, i: int, start: int, stop: int) -> np.ndarray:
        """Ids start..stop of document i: only the symbols that hold them are expanded."""
        seq = self.symbols[self.bounds[i] : self.bounds[i + 1]].astype(np.int64)
        own = np.ones(len(seq), np.int64)
        own[seq >= self.base] = self.lengths[seq[seq >= self.base] - self.base]
        ends = np.cumsum(own)
        a, b = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        got = expand(seq[a:b], self.rules, self.base)
        skip = start - (int(ends[a - 1]) if a else 0)
        return got[skip : skip + max(0, stop - start)]


SHARDS = "part int, shard int, part_start long, n_ids long, doc_ids array<long>, blob binary"


def write_ids(docs: DataFrame, tokenizer: str, path: str, end_id: int = END_ID, shard_ids: int = SHARD_IDS,
              id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes the ids of every text, ``end_id`` after each, as shards in ascending id order below ``path``.

    One range shuffle of id and text. A task streams its sorted rows and holds
    one shard of some ``shard_ids`` ids, so neither long texts nor many documents
    gather in memory. Null ids come first; repeated rows are written each; a null
    text is the end id alone; an empty table writes no shard.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = WordIds(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], np.uint32)
        shard, before, held, ids = 0, 0, [], []

        def flush():
            nonlocal shard, before, held, ids
            size = np.array([len(x) for x in ids], np.int64)
            blob = pack(np.concatenate(ids), np.cumsum(size))
            row = [[part], [shard], [before], [int(size.sum())], [held], [blob]]
            shard, before, held, ids = shard + 1, before + int(size.sum()), [], []
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                ["part", "shard", "part_start", "n_ids", "doc_ids", "blob"],
            )

        waiting = 0
        for batch in batches:
            for run in slices(batch, "text"):
                for i, got in zip(run.column("doc_id").to_pylist(), coder.encode(run.column("text").to_pylist())):
                    held.append(i)
                    ids.append(np.append(got, end))
                    waiting += len(ids[-1])
                    if waiting >= shard_ids:
                        yield flush()
                        waiting = 0
        if ids:
            yield flush()

    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = id_and_text(docs, id_col, text_col).repartitionByRange(n, F.col("doc_id")).sortWithinPartitions("doc_id")
    map_arrow(rows, encode, SHARDS).write.parquet(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Decodes the shards below ``path``: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    Where a part begins is a running sum over one row per part, a number that the
    writer's partition count bounds.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    parts = shards.groupBy("part").agg(F.min("shard").alias("s_"), F.sum("n_ids").alias("ids_"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("ids_").over(before), F.lit(0)).alias("base"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                shard, start, out = Shard(row["blob"]), row["base"] + row["part_start"], []
                for doc, ids in zip(row["doc_ids"], shard.documents()):
                    out.append((doc, start, len(ids), crc_of_ids(ids)))
                    start += len(ids)
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(shards.join(F.broadcast(bases), "part"), decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op8_grammar_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-ids")
    write_ids(documents(spark, sf_dir), public_path("word_bpe_49k.json"), path)
    return read_ids(spark, path)


QUERIES = {"op8_grammar_ids": op8_grammar_ids}
