"""Sufficient statistics of encoded rows, per fold, in one pass.

Each task adds up its own rows with one matrix product per batch and emits one
small vector per fold (and class). Those vectors are summed inside the JVM in
two levels, so no single task receives the partial sums of all others.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from tablewright.operators.design import MAX_GRAM, TEST, DiagonalMap, bare, batches, dense_map
from tablewright.session import map_arrow

SALT = 32


def tree_sum(partials: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Element-wise sum of ARRAY<DOUBLE> per key: salted first, then per key."""
    salted = (
        partials.select(*keys, array_to_vector(value).alias("v"), (F.spark_partition_id() % SALT).alias("salt"))
        .groupBy(*keys, "salt")
        .agg(Summarizer.sum(F.col("v")).alias("v"))
    )
    return salted.groupBy(*keys).agg(Summarizer.sum(F.col("v")).alias("v")).select(
        *keys, vector_to_array("v").alias(value)
    )


DIRECT_BYTES = 64 << 20


def total_of(rows: DataFrame, partials: DataFrame, keys: list[str], value: str, doubles: int) -> dict[tuple, np.ndarray]:
    """Sums per key on the driver. The keys number folds x classes at most.

    ``doubles``: numbers that each task sends. While all tasks together send 64 MB
    at most, their vectors go straight back; beyond that executors add them up in
    two levels first.
    """
    if rows.rdd.getNumPartitions() * doubles * 8 > DIRECT_BYTES:
        partials = tree_sum(partials, keys, value)
    out: dict[tuple, np.ndarray] = {}
    table = partials.select(*keys, value).toArrow()
    names = [table.column(k).to_pylist() for k in keys]
    for i, v in enumerate(table.column(value)):
        key = tuple(n[i] for n in names)
        v = v.values.to_numpy(zero_copy_only=False)
        out[key] = out[key] + v if key in out else v
    return out


@dataclass
class Moments:
    """Sums per fold (and class) as arrays: [fold] or [fold, class] first."""

    k: int
    n_classes: int
    sums: np.ndarray  # [fold, class, D]   sum of encoded rows
    squares: np.ndarray  # [fold, class, D]   sum of squares
    gram: np.ndarray | None  # [fold, D, D]
    xy: np.ndarray  # [fold, D]          sum of y * encoded row
    yy: np.ndarray  # [fold]
    class_gram: np.ndarray | None = None  # [fold, class, D, D]

    def train(self, name: str, t: int) -> np.ndarray:
        """Statistic over the training rows of subset ``t``; t == k is all folds."""
        a = getattr(self, name)
        return a.sum(axis=0) if t == self.k else a.sum(axis=0) - a[t]

    def n(self, t: int) -> float:
        return float(self.train("sums", t)[:, 0].sum())


def fold_moments(rows: DataFrame, enc, k: int, n_classes: int = 1, gram: bool = True,
                 class_gram: bool = False) -> Moments:
    """One pass over the training rows. ``n_classes=1`` for a numeric target."""
    d = enc.width
    if (gram or class_gram) and d > MAX_GRAM:
        raise ValueError(f"{d} encoded columns exceed {MAX_GRAM}; select features first or use an iterative model")
    upper = np.triu_indices(d)

    def accumulate(it):
        sums = np.zeros((k, n_classes, d))
        squares = np.zeros((k, n_classes, d))
        grams = np.zeros((k, d, d)) if gram else None
        per_class = np.zeros((k, n_classes, d, d)) if class_gram else None
        xy, yy = np.zeros((k, d)), np.zeros(k)
        for b in batches(enc, it):
            label = b.y.astype(int) if n_classes > 1 else np.zeros(b.n, int)
            for f in np.unique(b.fold):
                if f < 0:
                    continue
                part = b.pick(b.fold == f)
                lab = label[b.fold == f]
                if gram and not class_gram:
                    grams[f] += part.gram()
                xy[f] += part.transposed_times(part.y[:, None])[:, 0]
                yy[f] += part.y @ part.y
                for c in np.unique(lab):
                    own = part.pick(lab == c) if n_classes > 1 else part
                    sums[f, c] += own.transposed_times(np.ones((own.n, 1)))[:, 0]
                    squares[f, c] += own.squares()
                    if class_gram:
                        per_class[f, c] += own.gram()
        kinds, folds, classes, stats = [], [], [], []

        def emit(kind, f, c, v):
            kinds.append(kind), folds.append(f), classes.append(c), stats.append(v)

        for f in range(k):
            if gram and not class_gram:
                emit("gram", f, 0, grams[f][upper])
            emit("xy", f, 0, np.append(xy[f], yy[f]))
            for c in range(n_classes):
                emit("class", f, c, np.concatenate([sums[f, c], squares[f, c]]))
                if class_gram:
                    emit("class_gram", f, c, per_class[f, c][upper])
        yield pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(folds, pa.int32()), pa.array(classes, pa.int32()),
             pa.array(stats, pa.list_(pa.float64()))],
            ["kind", "fold", "cls", "stats"],
        )

    partials = map_arrow(
        bare(rows.where(F.col("fold") != TEST)), accumulate, "kind string, fold int, cls int, stats array<double>"
    )
    out = Moments(
        k, n_classes, np.zeros((k, n_classes, d)), np.zeros((k, n_classes, d)),
        np.zeros((k, d, d)) if gram or class_gram else None, np.zeros((k, d)), np.zeros(k),
        np.zeros((k, n_classes, d, d)) if class_gram else None,
    )
    squares_of = d * (d + 1) // 2 * (n_classes if class_gram else 1 if gram else 0)
    sent = k * (squares_of + d + 1 + 2 * d * n_classes)
    for (kind, f, c), v in total_of(rows, partials, ["kind", "fold", "cls"], "stats", sent).items():
        if kind == "xy":
            out.xy[f], out.yy[f] = v[:d], v[d]
        elif kind == "class":
            out.sums[f, c], out.squares[f, c] = v[:d], v[d:]
        else:
            m = np.zeros((d, d))
            m[upper] = v
            m = m + m.T - np.diag(np.diag(m))
            if kind == "gram":
                out.gram[f] = m
            else:
                out.class_gram[f, c] = m
                out.gram[f] += m
    return out


def max_abs(rows: DataFrame, n_features: int, k: int) -> np.ndarray:
    """[fold, feature] largest absolute value; combined on the map side."""
    cells = rows.where(F.col("fold") != TEST).select("fold", F.arrays_zip("indices", "values").alias("z")).select(
        "fold", F.inline("z").alias("idx", "val")
    )
    out = np.zeros((k, n_features))
    for r in cells.groupBy("fold", "idx").agg(F.max(F.abs("val")).alias("m")).collect():
        out[r["fold"], r["idx"]] = r["m"]
    return out


def feature_maps(enc, m: Moments, rows: DataFrame | None = None) -> list:
    """Preparation of every training subset: one per held-out fold, then all rows."""
    if enc.sparse:
        tops = max_abs(rows, enc.n_features, m.k)
        maps = []
        for t in range(m.k + 1):
            top = np.delete(tops, t, axis=0).max(axis=0) if t < m.k else tops.max(axis=0)
            maps.append(DiagonalMap(np.where(top > 0, 1 / np.where(top > 0, top, 1), 1.0)))
        return maps
    return [
        dense_map(enc, m.train("sums", t).sum(axis=0), m.train("squares", t).sum(axis=0)) for t in range(m.k + 1)
    ]


def prepared_gram(fm, gram: np.ndarray) -> np.ndarray:
    """Gram matrix of (1, prepared features)."""
    a = fm.with_one()
    return a @ gram @ a.T


PIECE_BYTES = 32 << 20


def pieces(enc, it):
    """Batches of so few rows that a dense matrix of them stays small."""
    most = max(1, PIECE_BYTES // (8 * enc.width))
    for b in batches(enc, it):
        for at in range(0, b.n, most):
            yield b if b.n <= most else b.pick((np.arange(b.n) >= at) & (np.arange(b.n) < at + most))


def fourth_moments(rows: DataFrame, enc, m: Moments, maps) -> np.ndarray:
    """[subset, class] mean of ‖z‖⁴, z standardised within (subset, class); a second pass."""
    from tablewright.operators.closed import class_scales

    scales = [class_scales(m, fm, t) for t, fm in enumerate(maps)]
    shared = rows.sparkSession.sparkContext.broadcast((maps, scales))
    k, n_classes = m.k, m.n_classes

    def accumulate(it):
        total = np.zeros((k + 1, n_classes, 2))
        maps_, scales_ = shared.value
        for b in pieces(enc, it):
            label = b.y.astype(int)
            for t in range(k + 1):
                x = maps_[t].rows(b)
                mu, std = scales_[t]
                z = (x - mu[label]) / std[label]
                q = (z * z).sum(axis=1) ** 2
                for c in np.unique(label):
                    mine = (label == c) & (b.fold != t)
                    total[t, c] += (q[mine].sum(), mine.sum())
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["stats"])

    partials = map_arrow(bare(rows.where(F.col("fold") != TEST)), accumulate, "stats array<double>")
    got = total_of(rows, partials.withColumn("k", F.lit(0)), ["k"], "stats", 2 * (k + 1) * n_classes)[(0,)]
    total = got.reshape(k + 1, n_classes, 2)
    shared.unpersist()
    return total[:, :, 0] / np.maximum(total[:, :, 1], 1)
