"""N-gram Jaccard join: MinHash bands, Bayesian candidate pruning, exact verification.

Documents are sets of five-word shingles. Rows of equal words collapse into one
text. Texts that share a band of their MinHash signature are candidates. The
signatures of a candidate pair are compared a few values at a time; a pair is
dropped once the posterior probability that its similarity reaches the threshold
falls below a tolerance. The pairs that are left are verified on their shingles.

Pairs live only inside a task: texts of a band bucket are dealt into blocks, a
unit of work is a pair of blocks, and what leaves it is a count of links per text
and a spanning forest, both as many rows as the unit has texts at most. A pair is
compared in the first band that it shares and nowhere else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.common import documents, id_and_text, keep_marked, slices, text_key
from tablewright.llm.components import components
from tablewright.llm.words import Words, chained, words_of
from tablewright.session import map_arrow, materialize

SHINGLE = 5
THRESHOLD = 0.8
HASHES, ROWS = 128, 4  # a pair at the threshold shares no band of 32 with probability 5e-8
STEP = 32  # values compared at a time
TOLERANCE = 1e-6
BLOCK = 512  # texts
PAIRS = 1 << 15  # compared at once
FILTER_BITS = 25
RUN_BYTES = 1 << 20

_MULTIPLIERS = np.random.default_rng(31337).integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, step: int = STEP, hashes: int = HASHES) -> dict[int, int]:
    """Fewest equal values among the first n that keep P(similarity >= threshold) at the tolerance, from a uniform prior.

    The posterior is Beta(m + 1, n - m + 1); its tail beyond t is the binomial P(X <= m) of n + 1 trials.
    """
    out = {}
    for n in range(step, hashes + 1, step):
        tail = 0.0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                out[n] = m
                break
    return out


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all shingles, where each text's begin, and the end); a text of one to four words is one shingle."""
    h, inside = words.grams(SHINGLE)
    size = np.diff(words.bounds)
    n = np.maximum(size - SHINGLE + 1, 0)
    short = (size > 0) & (size < SHINGLE)
    ends = np.cumsum(np.where(short, 1, n))
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    begins = np.append(0, ends)
    lone = np.zeros(len(out), bool)
    lone[begins[:-1][short]] = True
    out[~lone] = h[inside]
    out[lone] = chained(words.hashes, words.bounds, 3)[short]
    return out, begins


def _signatures(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    full = np.diff(begins) > 0
    out = np.zeros((len(full), HASHES), np.uint32)
    at = begins[:-1][full]
    if len(at):
        for i, a in enumerate(_MULTIPLIERS):
            out[full, i] = np.minimum.reduceat(hashes * a, at) >> np.uint64(32)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def text_signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: uid, doc_id, text_key, w1, w2 (128-bit hash of the words), n_words, signature; written once."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in slices(batch, "text", RUN_BYTES):
                words = words_of(run.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [run.column("doc_id"), run.column("text_key"), *_word_keys(words), pa.array(np.diff(words.bounds), pa.int64()),
                     _binary(_signatures(*shingles(words)))],
                    ["doc_id", "text_key", "w1", "w2", "n_words", "signature"])

    own = id_and_text(docs, id_col, text_col).withColumn("text_key", text_key(F.col("text")))
    got = map_arrow(own, sign, "doc_id long, text_key long, w1 long, w2 long, n_words long, signature binary")
    return materialize(got.withColumn("uid", F.monotonically_increasing_id()), "signatures")


def _word_keys(words: Words) -> list[pa.Array]:
    return [pa.array(chained(words.hashes, words.bounds, k).view(np.int64), pa.int64()) for k in (1, 2)]


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of whole units; the last unit of a batch waits for the next batch."""
    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        if not table.num_rows:
            continue
        ends = _borders(table)
        held = table.slice(ends[-2])
        if ends[-2]:
            yield table.slice(0, ends[-2])
    if held is not None and held.num_rows:
        yield held


def _borders(table: pa.Table) -> np.ndarray:
    """Where each unit begins, and the end."""
    key = np.stack([table.column(c).to_numpy() for c in ("bucket", "low", "high")])
    return np.flatnonzero(np.append(np.append(True, (key[:, 1:] != key[:, :-1]).any(0)), True))


def _candidates(part: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of a unit, a bounded number at a time: within one block, or between two."""
    n = len(part)
    if low == high:
        left = right = np.arange(n)
    else:
        left, right = np.flatnonzero(part == low), np.flatnonzero(part == high)
    step = max(1, PAIRS // max(1, len(right)))
    for a in range(0, len(left), step):
        rows = left[a : a + step]
        x, y = np.repeat(rows, len(right)), np.tile(right, len(rows))
        if low == high:
            x, y = x[x < y], y[x < y]
        yield x, y


def _survivors(sig: np.ndarray, part: np.ndarray, band: int, low: int, high: int, least: dict[int, int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that first meet in this band and whose posterior stays above the tolerance."""
    bands = sig.reshape(len(sig), -1, ROWS)
    for x, y in _candidates(part, low, high):
        ok = (bands[x, band] == bands[y, band]).all(1)
        x, y = x[ok], y[ok]
        for b in range(band):
            if not len(x):
                break
            ok = ~(bands[x, b] == bands[y, b]).all(1)
            x, y = x[ok], y[ok]
        equal = np.zeros(len(x), np.int64)
        for n, m in least.items():
            if not len(x):
                break
            equal = equal + (sig[x, n - STEP : n] == sig[y, n - STEP : n]).sum(1)
            ok = equal >= m
            x, y, equal = x[ok], y[ok], equal[ok]
        if len(x):
            yield x, y


def _pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each unit that have a pair left."""
    least = least_matches()
    for table in _units(batches):
        sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
        part, band = table.column("block").to_numpy(), table.column("band").to_numpy()
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        ends, keep = _borders(table), np.zeros(table.num_rows, bool)
        for a, b in zip(ends[:-1], ends[1:]):
            if b - a < 2:
                continue
            for x, y in _survivors(sig[a:b], part[a:b], int(band[a]), int(low[a]), int(high[a]), least):
                keep[a + x] = keep[a + y] = True
        for got in table.filter(pa.array(keep)).combine_chunks().to_batches():
            yield got


def _common(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of common shingles of every pair (x, y)."""
    if len(x) <= 16:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(x, y)], np.int64)
    used, at = np.unique(np.append(x, y), return_inverse=True)
    x, y = at[: len(x)], at[len(x) :]
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    values, column, times = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True, return_counts=True)
    # shingles of one text alone can't be common; the others go through a product, some columns at a time
    shared = np.cumsum(times > 1) - 1
    keep = times[column] > 1
    owner, column = owner[keep], shared[column[keep]]
    out, width = np.zeros(len(x), np.int64), 2048
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for begin in range(0, int((times > 1).sum()), width):
        a, b = np.searchsorted(column, [begin, begin + width])
        has = np.zeros((len(used), width), np.float32)
        has[owner[a:b], column[a:b] - begin] = 1
        out += (has @ has.T)[x, y].astype(np.int64)
    return out


def _joined(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest labels after linking x with y; ``root`` holds the labels before, every label its own."""
    while True:
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        if (low == high).all():
            return root
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per unit: (uid, its links in this unit, a neighbour in the unit's spanning forest or null)."""
    least = least_matches()
    for table in _units(batches):
        sig = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, HASHES)
        part, band, uid = (table.column(c).to_numpy() for c in ("block", "band", "uid"))
        low, high = table.column("low").to_numpy(), table.column("high").to_numpy()
        raw, ends = table.column("shingles"), _borders(table)
        out: list[tuple] = []
        for a, b in zip(ends[:-1], ends[1:]):
            if b - a < 2:
                continue
            sets = [np.frombuffer(raw[int(i)].as_buffer(), np.uint64) for i in range(a, b)]
            size = np.array([len(s) for s in sets])
            links, root = np.zeros(b - a, np.int64), np.arange(b - a)
            for x, y in _survivors(sig[a:b], part[a:b], int(band[a]), int(low[a]), int(high[a]), least):
                common = _common(sets, x, y)
                ok = common >= THRESHOLD * (size[x] + size[y] - common) - 1e-9
                x, y = x[ok], y[ok]
                links += np.bincount(x, minlength=b - a) + np.bincount(y, minlength=b - a)
                root = _joined(root, x, y)
            some = np.flatnonzero(links)
            own = uid[a:b]
            out += zip(own[some].tolist(), links[some].tolist(), own[root[some]].tolist())
        cols = list(zip(*out)) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["uid", "links", "other"])


def _shingles_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(w1, w2, shingles) of the texts that may be among ``wanted`` (w1): a filter of fixed size lets the others pass by."""
    address = F.shiftrightunsigned("w1", 64 - FILTER_BITS) + 1
    pages = wanted.groupBy(F.bitmap_bucket_number(address).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(address)).alias("bits"))
    bits = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    for page, part in pages.collect():  # 1,024 pages at most
        bits[(page - 1) * 4096 : page * 4096] = np.frombuffer(part, np.uint8)
    flags = docs.sparkSession.sparkContext.broadcast(bits)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = flags.value
        for batch in batches:
            for run in slices(batch, "text", RUN_BYTES):
                words = words_of(run.column("text"))
                w1, w2 = (chained(words.hashes, words.bounds, k) for k in (1, 2))
                at = (w1 >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                hit = np.flatnonzero(((known[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0) & (np.diff(words.bounds) > 0))
                hit = hit[np.unique(w1[hit], return_index=True)[1]]
                h, begins = shingles(words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1[hit].view(np.int64)), pa.array(w2[hit].view(np.int64)),
                     pa.array([np.unique(h[begins[i] : begins[i + 1]]).tobytes() for i in hit], pa.binary())], ["w1", "w2", "shingles"])

    return map_arrow(docs, gather, "w1 long, w2 long, shingles binary")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, class_id, n_links, n_copies, kept, text_key.

    ``class_id`` is the smallest id among all rows that links connect; n_links
    counts the other texts (by their words) at a similarity of ``THRESHOLD`` or
    more; n_copies the rows of the same words. ``kept`` marks one row of each
    class, the smallest id, null ids last. A text without words is a class of its
    own. Repeated rows are copies. An empty table gives no rows.
    """
    signed = text_signatures(docs, id_col, text_col)
    copies = materialize(signed.where("n_words > 0").groupBy("w1", "w2").agg(F.min("uid").alias("rep"), F.count(F.lit(1)).alias("n_copies")), "copies")
    texts = signed.join(copies.select(F.col("rep").alias("uid")), "uid", "left_semi").select("uid", "w1", "w2", "signature")
    keyed = texts.select("uid", F.posexplode(F.array(*[
        F.xxhash64(F.lit(b), F.substring("signature", 4 * ROWS * b + 1, 4 * ROWS)) for b in range(HASHES // ROWS)])).alias("band", "bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = materialize(keyed.join(shared, "bucket").select(
        "uid", "band", "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "buckets")
    parts = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")

    def by_unit(rows: DataFrame) -> DataFrame:
        return rows.repartition(int(parts), "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")

    block = F.pmod(F.xxhash64("uid"), F.col("blocks")).cast("int")
    units = members.withColumn("block", block).join(texts.select("uid", "signature"), "uid").withColumn(
        "with_", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "bucket", F.least("block", "with_").alias("low"), F.greatest("block", "with_").alias("high"), "block", "band", "uid", "signature")
    schema = "bucket long, low int, high int, block int, band int, uid long, signature binary"
    left = materialize(map_arrow(by_unit(units), _pruned, schema).drop("signature"), "pruned")
    involved = materialize(texts.join(left.select("uid").distinct(), "uid", "left_semi"), "involved")
    sets = _shingles_of(id_and_text(docs, id_col, text_col), involved).groupBy("w1", "w2").agg(F.first("shingles").alias("shingles"))
    loaded = materialize(involved.join(sets, ["w1", "w2"]).select("uid", "signature", "shingles"), "shingles")
    checked = materialize(map_arrow(by_unit(left.join(loaded, "uid")), _verified, "uid long, links long, other long"), "checked")
    degree = checked.groupBy("uid").agg(F.sum("links").alias("n_links"))
    roots = components(checked.select(F.col("uid").alias("a"), F.col("other").alias("b")))
    linked = copies.join(degree, copies["rep"] == degree["uid"], "left").drop("uid").join(roots, copies["rep"] == roots["node"], "left").select(
        "w1", "w2", "n_copies", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("root", "rep").alias("label"))
    rows = signed.select("uid", "doc_id", "text_key", "n_words", "w1", "w2")
    own = rows.where("n_words = 0").select("uid", "doc_id", "text_key", F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"), F.col("uid").alias("label"))
    labelled = materialize(rows.where("n_words > 0").join(linked, ["w1", "w2"]).select("uid", "doc_id", "text_key", "n_copies", "n_links", "label").unionByName(own), "labelled")
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "uid")
    # written, so that the join doesn't share the aggregate's partitions and a large class can be split
    classes = materialize(labelled.groupBy("label").agg(F.min(order).alias("first")), "classes")
    return labelled.join(classes, "label").select(
        "doc_id", F.col("first.doc_id").alias("class_id"), "n_links", "n_copies", (F.col("uid") == F.col("first.uid")).alias("kept"), "text_key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each class, all columns as they are."""
    return keep_marked(docs, near_groups(docs, id_col, text_col), id_col, text_col)


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir)).drop("text_key")


QUERIES = {"op7_ngram_jaccard": op7_ngram_jaccard}
