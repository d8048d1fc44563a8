"""Toxicity score: subword-bag embeddings, averaged, into a linear softmax.

A text is the bag of its words and their character n-grams (with a mark on either
side of a word), hashed into buckets. The embeddings of a text's bag are averaged
and go through a linear layer to two classes; embeddings and layer are trained
jointly with numpy on a bounded sample of labelled rows. A misspelt or inflected
word shares n-grams with the words that were seen.

After training, each bucket's contribution to the difference of the two classes is
one number, so scoring a text is a sum of look-ups over its characters.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm.common import documents, id_and_text, slices
from tablewright.llm.words import mixed
from tablewright.session import map_arrow

TOXIC_SAMPLE, CLEAN_SAMPLE = 1500, 4500  # labelled rows of either class that are learned from, at most
SIZES = (3, 4, 5)  # characters of an n-gram
BITS = 17  # buckets
WIDTH = 8  # of an embedding
SCALE = 30.0  # of the averaged embedding
PRIOR = 1000.0  # neutral subwords added to every text: a few words alone prove little
STEPS, BATCH, RATE = 3000, 32, 0.5
THRESHOLD = 0.5
FOLDS = 5  # rows whose crc32(id) divides by this are never learned from

_rng = np.random.default_rng(5150)
_BASE = int(_rng.integers(1 << 62, 1 << 63)) | 1
_MARK = ord(" ")
_CODES = 1 << 16
_SALT = _rng.integers(1, 1 << 63, _CODES, dtype=np.uint64) | np.uint64(1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def subwords(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bucket, whether the position holds one, bounds of every text), for words and each n-gram size.

    Only the first occurrence of a word in its text counts, so a text that
    repeats one word doesn't drown in it.
    """
    lowered = [t.lower() for t in texts]
    joined = " " + " ".join(lowered) + " "
    code = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    borders = np.append(0, np.cumsum([len(t) + 1 for t in lowered]))
    inside = code >= 0x80
    inside |= (code >= 0x30) & (code < 0x3A) | (code >= 0x61) & (code < 0x7B)
    code = np.where(inside, code, _MARK)
    edge = np.flatnonzero(np.diff(inside.astype(np.int8)))
    first, last = edge[::2] + 1, edge[1::2] + 1  # the joined text begins and ends outside a word
    n = len(code)
    up, down = _powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_SALT[code & (_CODES - 1)] * up[:n], out=sums[1:])
    word = mixed((sums[last] - sums[first]) * down[first] ^ np.uint64(0xABCDEF))
    owner = np.searchsorted(borders, first, "right")
    kept = np.sort(np.unique(word ^ mixed(owner.astype(np.uint64)), return_index=True)[1])
    first, last, word, owner = first[kept], last[kept], word[kept], owner[kept]
    shift = np.uint64(64 - BITS)
    yield (word >> shift).astype(np.int64), np.ones(len(word), bool), np.searchsorted(owner, np.arange(1, len(texts) + 2))
    # a gram begins at the mark before a word or inside it, and ends at the mark behind it at most
    length = last - first + 1
    at = np.repeat(first - 1 - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))
    limit = np.repeat(last + 1, length)
    bounds = np.append(0, np.cumsum(length))[np.searchsorted(owner, np.arange(1, len(texts) + 2))]
    for size in SIZES:
        valid = at + size <= limit
        h = (sums[np.minimum(at + size, n)] - sums[at]) * down[at] * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        h *= np.uint64(0xBF58476D1CE4E5B9 + 2 * size)
        yield (h >> shift).astype(np.int64), valid, bounds


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.append(0, np.cumsum(values))[bounds])


@dataclass
class Model:
    """Score = sigmoid(bias + mean of the weights of a text's subwords and ``PRIOR`` neutral ones)."""

    weights: np.ndarray
    bias: float

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        total = count = 0
        for bucket, valid, bounds in subwords(texts):
            total = total + _sums(np.where(valid, self.weights[bucket], 0.0), bounds)
            count = count + _sums(valid, bounds)
        z = self.bias + total / (count + PRIOR)
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _bags(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of (bucket, share of the text's subwords), text after text, and where each text begins."""
    ids, shares, ends = [], [], [0]
    for t in texts:
        parts = [b[v] for b, v, _ in subwords([t])]
        found, n = np.unique(np.concatenate(parts), return_counts=True)
        ids.append(found.astype(np.int32))
        shares.append((n / (n.sum() + PRIOR)).astype(np.float32))
        ends.append(ends[-1] + len(found))
    return np.concatenate(ids), np.concatenate(shares), np.array(ends)


def train(texts: list[str], labels: np.ndarray, rate: float = RATE, seed: int = 11) -> Model:
    """Embeddings and softmax layer by mini-batch gradient descent.

    With one class only, or none, every text gets that class's score. A rate at
    which the weights grow without bound is halved.
    """
    if len(np.unique(labels)) < 2:
        return Model(np.zeros(1 << BITS), 10.0 if len(labels) and labels[0] else -10.0)
    bags = _bags(texts)
    with np.errstate(all="ignore"):
        while True:
            model = _descend(*bags, labels, rate, np.random.default_rng(seed))
            if np.isfinite(model.weights).all() and np.isfinite(model.bias):
                return model
            rate /= 2


def _descend(ids: np.ndarray, shares: np.ndarray, ends: np.ndarray, labels: np.ndarray, rate: float, rng) -> Model:
    table = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH)).astype(np.float32)
    layer, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    batches = -(-len(labels) // BATCH)
    epochs = -(-STEPS // batches)
    for epoch in range(epochs):
        for k, chosen in enumerate(np.array_split(rng.permutation(len(labels)), batches)):
            step_rate = rate * (1 - (epoch * batches + k) / (epochs * batches))
            n = ends[chosen + 1] - ends[chosen]
            chosen, n = chosen[n > 0], n[n > 0]  # a text without words says nothing
            if not len(chosen):
                continue
            starts = np.cumsum(n) - n
            rows = np.repeat(ends[chosen] - starts, n) + np.arange(int(n.sum()))
            own, part = ids[rows], shares[rows][:, None] * SCALE
            mean = np.add.reduceat(table[own] * part, starts)
            z = mean @ layer + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chosen)), labels[chosen]] -= 1
            step = np.repeat(p @ layer.T, n, axis=0) * part * step_rate
            layer -= step_rate / len(chosen) * (mean.T @ p)
            bias -= step_rate / len(chosen) * p.sum(0)
            for j in range(WIDTH):
                table[:, j] -= np.bincount(own, step[:, j], 1 << BITS)
    return Model(SCALE * (table @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic") -> tuple[list[str], np.ndarray]:
    """Texts and labels to learn from: the first rows of either class by a hash of the id, ``FOLDS`` held out.

    The number is bounded by TOXIC_SAMPLE and CLEAN_SAMPLE. Rows without id or
    label are left out; of several labels of an id the largest counts.
    """
    ids = labels.select(labels[id_col].cast("long").alias("lid"), labels[label].cast("int").alias("y")).where("lid is not null and y in (0, 1)")
    ids = ids.where(F.crc32(F.col("lid").cast("string").cast("binary")) % FOLDS != 0).groupBy("lid").agg(F.max("y").alias("y"))
    order = [F.xxhash64("lid"), F.col("lid")]
    chosen = ids.where("y = 1").orderBy(*order).limit(TOXIC_SAMPLE).unionByName(ids.where("y = 0").orderBy(*order).limit(CLEAN_SAMPLE))
    own = id_and_text(docs, id_col, text_col)
    rows = own.join(F.broadcast(chosen), own["doc_id"] == chosen["lid"]).select("lid", "y", "text").toPandas()
    rows = rows.drop_duplicates("lid").sort_values("lid")
    return rows["text"].tolist(), rows["y"].to_numpy(np.int64)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    return train(*labelled_sample(docs, labels, id_col, text_col))


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, score (0 to 1). Null and empty texts get the neutral text's score; map only."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for run in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([run.column("doc_id"), pa.array(own.score(run.column("text").to_pylist()))], ["doc_id", "score"])

    return map_arrow(id_and_text(docs, id_col, text_col), score, "doc_id long, score double")


def keep_civil(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns as they are; nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            # columns are taken by place: names may clash
            named = batch.rename_columns([f"c{i}" for i in range(batch.num_columns)])
            text = pa.compute.fill_null(named.column(at), "")
            named = pa.RecordBatch.from_arrays([*named.columns, text], [*named.schema.names, "t"])
            for run in slices(named, "t"):
                low = own.score(run.column("t").to_pylist()) < threshold
                left = run.filter(pa.array(low))
                yield pa.RecordBatch.from_arrays(left.columns[:-1], schema=batch.schema)

    return map_arrow(docs, keep, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted, learned from ``labels`` (doc_id, toxic).

    A null id is not held out; repeated rows are scored each; an empty table gives no rows.
    """
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    return scored(docs, fit(docs, labels)).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op10_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op10_subword_toxicity": op10_subword_toxicity}
