"""Benchmark decontamination by winnowing.

Of every six consecutive 5-word grams the one with the smallest hash is kept, in
documents and items alike, so any ten words that both hold share a kept gram.
Kept grams carry up to five words on either side; where an item's gram meets a
document's, the words are compared and the hit is extended, which shows every
shared ten-word window. An item of fewer than ten words is one gram of its own
length, and all grams of that length of a document are looked up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import documents, id_and_text, slices, text_key, without
from tablewright.llm.words import Words, words_of
from tablewright.session import map_arrow, materialize

WINDOW = 10  # words
GRAM = 5
FILTER_BITS = 25  # bits of the address in the filter of item grams: 4 MB whatever the number of items
RUN_BYTES = 2 << 20

GRAMS = "array<struct<hash: bigint, length: int, before: int, words: binary, at: array<int>>>"
GRAM_TYPE = pa.list_(pa.struct([("hash", pa.int64()), ("length", pa.int32()), ("before", pa.int32()), ("words", pa.binary()), ("at", pa.list_(pa.int32()))]))


def winnow(hashes: np.ndarray, inside: np.ndarray, w: int) -> np.ndarray:
    """Positions of the smallest hash (the last of equals) of every ``w`` consecutive grams of one text.

    ``inside``: whether a gram lies in one text; a run of w grams does if its
    first and last do, with all grams between.
    """
    n = len(hashes) - w + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    best, where, whole = hashes[:n].copy(), np.zeros(n, np.int64), inside[:n].copy()
    for j in range(1, w):
        less = hashes[j : j + n] <= best
        best[less] = hashes[j : j + n][less]
        where[less] = j
        whole &= inside[j : j + n]
    return np.unique((np.arange(n) + where)[whole])


def fingerprints(words: Words, lengths: list[int]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(window length, gram length, gram positions, hashes) for full windows and each shorter length."""
    h, inside = words.grams(GRAM)
    at = winnow(h, inside, WINDOW - GRAM + 1)
    yield WINDOW, GRAM, at, h[at]
    for m in lengths:
        h, inside = words.grams(m)
        at = np.flatnonzero(inside)
        # other bits than those of full windows
        yield m, m, at, h[at] ^ np.uint64(0x5851F42D4C957F2D)


def _gram_rows(words: Words, own: np.ndarray, kept) -> dict[int, dict]:
    """Per text: (hash, length, words before the gram, words around it) -> positions in the text."""
    rows: dict[int, dict] = {}
    for length, k, at, hashes in kept:
        around = length - k
        for p, h in zip(at.tolist(), hashes.view(np.int64).tolist()):
            i = int(own[p])
            a, b = max(p - around, int(words.bounds[i])), min(p + k + around, int(words.bounds[i + 1]))
            key = (h, length, p - a, words.text(a, b))
            rows.setdefault(i, {}).setdefault(key, []).append(p - int(words.bounds[i]))
    return rows


def _gram_array(rows: dict[int, dict], n: int) -> pa.Array:
    return pa.array([[{"hash": h, "length": m, "before": b, "words": w, "at": at} for (h, m, b, w), at in rows.get(i, {}).items()] for i in range(n)], GRAM_TYPE)


def item_grams(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id as string, hash, length, before, words): the kept grams of every item."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in slices(batch, "text", RUN_BYTES):
                words = words_of(run.column("text"))
                size = np.diff(words.bounds)
                own = words.owners()
                kept = []
                for length, k, at, h in fingerprints(words, sorted({int(s) for s in size if 0 < s < WINDOW})):
                    fit = size[own[at]] == length if length < WINDOW else np.ones(len(at), bool)
                    kept.append((length, k, at[fit], h[fit]))
                yield pa.RecordBatch.from_arrays([run.column("item_id"), _gram_array(_gram_rows(words, own, kept), run.num_rows)], ["item_id", "grams"])

    own = items.select(F.coalesce(items[id_col].cast("string"), F.lit("")).alias("item_id"), F.coalesce(items[text_col], F.lit("")).alias("text"))
    got = map_arrow(own, grams, f"item_id string, grams {GRAMS}").select("item_id", F.explode("grams").alias("g"))
    return got.select("item_id", "g.hash", "g.length", "g.before", "g.words")


def _filter(grams: DataFrame) -> np.ndarray:
    """A bit for every address that an item gram has, as bytes; built by Spark in pages of 4 KB."""
    address = F.shiftrightunsigned("hash", 64 - FILTER_BITS) + 1
    pages = grams.groupBy(F.bitmap_bucket_number(address).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(address)).alias("bits"))
    out = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for page, bits in pages.collect():
        out[(page - 1) * 4096 : page * 4096] = np.frombuffer(bits, np.uint8)
    return out


def _extended(length: int, doc: tuple[list, int], item: tuple[list, int]) -> tuple[int, int] | None:
    """(words before, words after the gram's first) of the common stretch, if it holds a window."""
    k = GRAM if length == WINDOW else length
    (d, at), (x, own) = doc, item
    if d[at : at + k] != x[own : own + k]:
        return None
    left = right = 0
    while left < min(at, own) and d[at - left - 1] == x[own - left - 1]:
        left += 1
    while right < min(len(d) - at, len(x) - own) - k and d[at + k + right] == x[own + k + right]:
        right += 1
    return (left, k + right) if left + k + right >= length else None


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, text_key, n_words, n_hit, n_items, items_sha256, contaminated.

    A word is hit if it lies in any occurrence of a ten-word window of an item
    (of the whole item, if it is shorter). Null and empty texts and items have no
    words; a null item id counts as the id ''; repeated rows are judged each;
    without items nothing is hit; no documents, no rows. Documents are read once.
    A gram goes on to the join only if an item has one at its address in a filter
    of fixed size; items of any number stay in a table.
    """
    bench = materialize(item_grams(items, item_id, item_text), "item-grams")
    lengths = sorted(r[0] for r in bench.select("length").where(F.col("length") < WINDOW).distinct().collect())  # nine at most
    flags = docs.sparkSession.sparkContext.broadcast(_filter(bench))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = flags.value
        for batch in batches:
            for run in slices(batch, "text", RUN_BYTES):
                words = words_of(run.column("text"))
                kept = []
                for length, k, at, h in fingerprints(words, lengths):
                    a = (h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    hit = (bits[a >> 3] >> (a & 7).astype(np.uint8)) & 1 > 0
                    kept.append((length, k, at[hit], h[hit]))
                rows = _gram_rows(words, words.owners(), kept) if any(len(x[2]) for x in kept) else {}
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id"), run.column("text_key"), pa.array(np.diff(words.bounds), pa.int64()), _gram_array(rows, run.num_rows)],
                    ["doc_id", "text_key", "n_words", "grams"])

    own = id_and_text(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    seen = map_arrow(own, scan, f"doc_id long, text_key long, n_words long, grams {GRAMS}")
    seen = materialize(seen.withColumn("uid", F.monotonically_increasing_id()), "scanned")

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                span = _extended(r["length"], (r["words"].split(b" "), r["before"]), (r["item_words"].split(b" "), r["item_before"]))
                if span:
                    out += [(r["uid"], r["item_id"], p - span[0], p + span[1]) for p in r["at"]]
            cols = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.int32(), pa.int32()))], ["uid", "item_id", "a", "b"])

    mine = seen.select("uid", F.explode("grams").alias("g")).select("uid", "g.*")
    theirs = bench.select("item_id", "hash", "length", F.col("before").alias("item_before"), F.col("words").alias("item_words"))
    spans = materialize(map_arrow(mine.join(theirs, ["hash", "length"]), extend, "uid long, item_id string, a int, b int"), "hits")
    before = F.max("b").over(Window.partitionBy("uid").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("b") - F.greatest("a", F.coalesce(before, F.lit(0))))
    hit = spans.select("uid", "a", "b").distinct().withColumn("fresh", fresh).groupBy("uid").agg(F.sum("fresh").alias("n_hit"))
    named = spans.select("uid", "item_id").distinct().groupBy("uid").agg(
        F.count(F.lit(1)).alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("item_id"))).alias("ids"))
    none = F.lit(0).cast("long")
    return seen.select("uid", "doc_id", "text_key", "n_words").join(hit, "uid", "left").join(named, "uid", "left").select(
        "doc_id", "text_key", "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
        F.sha2(F.coalesce("ids", F.lit("")), 256).alias("items_sha256"), (F.coalesce("n_hit", none) > 0).alias("contaminated"))


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that hold a window of an item."""
    found = contamination(docs, items, id_col, text_col).where("contaminated").select("doc_id", "text_key").distinct()
    return without(docs, found, id_col, text_col)


def op2_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet")).drop("text_key")


QUERIES = {"op2_winnowing": op2_winnowing}
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = {
    "op2_winnowing": f"""
with d as (select doc_id, {_WORDS} as w from documents),
i as (select item_id, {_WORDS} as w from benchmark),
ip as (select item_id, w, least(len(w), 10) as k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as p from i where len(w) > 0),
iw as (select distinct item_id, k, array_to_string(w[p:p + k - 1], ' ') as g from ip),
dp as (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as p from d, (select distinct k from iw)),
dw as (select doc_id, k, p, array_to_string(w[p:p + k - 1], ' ') as g from dp),
hits as (select doc_id, item_id, p, k from dw join iw using (k, g)),
words as (select doc_id, count(*) as n from (select distinct doc_id, unnest(range(p, p + k)) as q from hits) group by doc_id),
named as (select doc_id, count(*) as n, string_agg(i, ',' order by i) as ids
  from (select distinct doc_id, item_id::varchar as i from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(words.n, 0)::bigint as n_hit, coalesce(named.n, 0)::bigint as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(words.n, 0) > 0 as contaminated
from d left join words using (doc_id) left join named using (doc_id)"""
}
