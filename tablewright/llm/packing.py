"""Best-fit packing of token documents into fixed sequences, in bulk-synchronous rounds.

Documents and open gaps are ordered by size. In a round every size of document,
largest first, takes its successor: the smallest gap it fits in; the gaps of one
size go to documents by rank, each gap to one size of document a round. Taken
gaps shrink and come back in the next round. Documents without a gap wait for
those if their volume, as far as it isn't promised to larger ones, is enough; the
others open new sequences. The rounds end when all are placed.

Sizes are at most the sequence length, so the counts by size that steer a round
are a small table (``capacity`` x ``SALTS`` rows) whatever the number of rows.
Rows themselves are ranked, matched and updated by Spark jobs and written to the
shared folder after each round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.llm.common import class_rank, documents, id_and_text, slices
from tablewright.llm.tokens import WordIds, crc_of_ids, public_path
from tablewright.session import map_arrow, materialize, small_table

CAPACITY = 2048
SEPARATOR = 0
SALTS = 16

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"
MOVES = {"size": pa.int64(), "gap": pa.int64(), "doc_from": pa.int64(), "docs": pa.int64(), "gap_from": pa.int64(),
         "gaps": pa.int64(), "each": pa.int64(), "base": pa.int64()}


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, separator: int = SEPARATOR,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document: its ids and ``separator``, cut only beyond ``capacity``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = WordIds(tokenizer), np.array([separator], np.uint32)
        for batch in batches:
            for run in slices(batch, "text"):
                out = []
                for doc, ids in zip(run.column("doc_id").to_pylist(), coder.encode(run.column("text").to_pylist())):
                    ids = np.append(ids, end)
                    for k, a in enumerate(range(0, len(ids), capacity)):
                        part = ids[a : a + capacity]
                        out.append((doc, k, a, len(part), crc_of_ids(part)))
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    got = map_arrow(id_and_text(docs, id_col, text_col), cut, PIECES.split(", ", 1)[1])
    return materialize(got.withColumn("uid", F.monotonically_increasing_id()), "pieces").select("uid", "doc_id", "piece", "start", "length", "ids_crc32")


def sweep(waiting: np.ndarray, taken: np.ndarray, gaps: np.ndarray, capacity: int, next_id: int) -> tuple[list[dict], list[dict], int]:
    """One round over counts by size: (moves into gaps, newly opened sequences, next sequence id).

    ``waiting`` and ``gaps``: rows by size; ``taken``: documents of each size
    placed before, which is the first free rank. All three are updated.
    """
    moves, opened = [], []
    used = np.zeros(capacity + 1, np.int64)  # gaps of a size given away in this round, by rank
    later = np.zeros(capacity + 1, np.int64)  # gaps that come back in the next round
    promised = 0
    free = gaps.copy()
    for size in range(capacity, 0, -1):
        if not waiting[size]:
            continue
        for gap in size + np.flatnonzero(free[size:]):
            n = int(waiting[size])
            if not n:
                break
            each = int(gap // size)
            full = min(int(free[gap]), n // each)
            for count, take in ((full, each), (1 if full < free[gap] and n - full * each > 0 else 0, n - full * each)):
                if count:
                    moves.append({"size": size, "gap": int(gap), "doc_from": int(taken[size]), "docs": count * take,
                                  "gap_from": int(used[gap]), "gaps": count, "each": take, "base": 0})
                    used[gap] += count
                    free[gap] -= count
                    taken[size] += count * take
                    waiting[size] -= count * take
                    later[gap - take * size] += count
        n = int(waiting[size])
        if n:
            room = int(later[size:] @ np.arange(size, capacity + 1)) - promised
            stay = min(n, max(0, room // size))
            promised += stay * size
            waiting[size] = stay
            n -= stay
            each = capacity // size
            for count, take in ((n // each, each), (int(n % each > 0), n % each)):
                if count:
                    opened.append({"size": size, "gap": capacity, "doc_from": int(taken[size]), "docs": count * take,
                                   "gap_from": 0, "gaps": count, "each": take, "base": next_id})
                    next_id += count
                    taken[size] += count * take
                    later[capacity - take * size] += count
    return moves, opened, next_id


def _counts(df: DataFrame, column: str, capacity: int) -> np.ndarray:
    out = np.zeros(capacity + 1, np.int64)
    for size, n in df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).collect():  # at most ``capacity`` rows
        out[size] = n
    return out


def _table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return small_table(spark, {c: [r[c] for r in rows] for c in MOVES}, MOVES)


def _salt(column: Column) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS))


def best_fit(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (uid, length, ...; 1 <= length <= capacity).

    An empty table gives no rows; equal lengths are told apart by rank; a length
    that a third of all rows share is ranked in salted parts.
    """
    spark = pieces.sparkSession
    whole = pieces.where(F.col("length") == capacity)
    ranked = materialize(
        class_rank(pieces.where(F.col("length") < capacity).select("uid", F.col("length").alias("size")), ["size"],
                   _salt(F.col("uid")), [F.col("uid")]), "ranked")
    waiting = _counts(ranked, "size", capacity)
    taken, next_id = np.zeros(capacity + 1, np.int64), 0
    gaps, fills = None, []
    while waiting.any():
        counts = _counts(gaps, "gap", capacity) if gaps is not None else np.zeros(capacity + 1, np.int64)
        counts[0] = 0
        moves, opened, next_id = sweep(waiting, taken, counts, capacity, next_id)
        steps = []
        if opened:
            # sequence k of an opening begins with the document of rank doc_from + k * each
            plan = _table(spark, opened)
            own = F.col("rank") - F.col("doc_from")
            steps.append(
                ranked.join(F.broadcast(plan), "size")
                .where((own >= 0) & (own < F.col("docs")) & (own % F.col("each") == 0))
                .select((F.col("base") + F.expr("(rank - doc_from) div each")).alias("sequence_id"),
                        (capacity - F.col("size") * F.col("each")).alias("gap"), F.lit(0).cast("long").alias("offset"),
                        "size", F.col("rank").alias("doc_from"), "each"))
        if gaps is not None:
            plan = _table(spark, moves)
            live = class_rank(gaps.where("gap > 0").select("sequence_id", "gap"), ["gap"], _salt(F.col("sequence_id")),
                              [F.col("sequence_id")], "at")
            own = F.col("at") - F.col("gap_from")
            hit = plan.select(*[F.col(c).alias(f"m_{c}") for c in MOVES])
            matched = live.join(F.broadcast(hit), (live["gap"] == hit["m_gap"]) & (live["at"] >= hit["m_gap_from"])
                                & (live["at"] < hit["m_gap_from"] + hit["m_gaps"]), "left")
            steps.append(matched.select(
                "sequence_id", (F.col("gap") - F.coalesce(F.col("m_size") * F.col("m_each"), F.lit(0))).alias("gap"),
                (capacity - F.col("gap")).alias("offset"), F.col("m_size").alias("size"),
                (F.col("m_doc_from") + (F.col("at") - F.col("m_gap_from")) * F.col("m_each")).alias("doc_from"),
                F.col("m_each").alias("each")))
        state = steps[0] if len(steps) == 1 else steps[0].unionByName(steps[1])
        state = materialize(state, "gaps")
        gaps = state.select("sequence_id", "gap")
        fills.append(state.where("size is not null").select("sequence_id", "offset", "size", "doc_from", "each"))
    lone = whole.select("*", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if not fills:
        return lone
    filled = fills[0]
    for more in fills[1:]:
        filled = filled.unionByName(more)
    # one fill holds at most ``capacity`` documents
    placed = filled.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("each") - 1))).select(
        "size", (F.col("doc_from") + F.col("k")).alias("rank"), "sequence_id", (F.col("offset") + F.col("k") * F.col("size")).alias("offset"))
    by_uid = ranked.join(placed, ["size", "rank"]).select("uid", "sequence_id", "offset")
    return pieces.join(by_uid, "uid").unionByName(lone)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Packs all documents; one row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the separator alone; a null id stays null; repeated
    rows are packed each; an empty table gives no rows. A very long text is cut
    into full sequences and one rest.
    """
    placed = best_fit(cut_pieces(docs, tokenizer, capacity, id_col=id_col, text_col=text_col), capacity)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), public_path("word_bpe_49k.json"))


QUERIES = {"op6_best_fit_packing": op6_best_fit_packing}
