"""Rows for training, and the linear maps from raw rows to prepared features.

A training row is encoded once, independent of any fold: a leading 1, shifted
numbers (0 where missing), a flag per column that has missing values, and one
flag per category. Imputation, scaling and one-hot of *any* training subset are
linear in this encoding, so one cached table serves every fold, and statistics
gathered on it can be mapped to each fold's prepared features afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame, functions as F

from tablewright.errors import DataFormatError
from tablewright.functions.roles import Roles
from tablewright.operators.prepare import MAX_CATEGORIES, Preparation, category_counts, numeric_statistics, present
from tablewright.session import map_arrow

MAX_GRAM = 4096
TEST = -1


class DenseBatch:
    """n x D matrix with a leading column of ones."""

    def __init__(self, u: np.ndarray, fold: np.ndarray, y: np.ndarray):
        self.u, self.fold, self.y, self.n = u, fold, y, len(y)

    def times(self, w: np.ndarray) -> np.ndarray:
        return self.u @ w

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        return self.u.T @ r

    def gram(self) -> np.ndarray:
        return self.u.T @ self.u

    def squares(self) -> np.ndarray:
        return (self.u * self.u).sum(axis=0)

    def pick(self, rows: np.ndarray) -> DenseBatch:
        return DenseBatch(self.u[rows], self.fold[rows], self.y[rows])


class SparseBatch:
    """Compressed rows; column 0 of the product space is the implicit 1."""

    def __init__(self, starts, idx, val, width, fold, y):
        self.starts, self.idx, self.val, self.width = starts, idx, val, width
        self.fold, self.y, self.n = fold, y, len(y)
        self.row = np.repeat(np.arange(self.n), np.diff(starts))

    def times(self, w: np.ndarray) -> np.ndarray:
        out = np.tile(w[0], (self.n, 1)).astype(float)
        some = np.flatnonzero(np.diff(self.starts))  # each of these rows runs up to the next one
        if len(some):
            out[some] += np.add.reduceat(self.val[:, None] * w[self.idx + 1], self.starts[some], axis=0)
        return out

    def transposed_times(self, r: np.ndarray) -> np.ndarray:
        out = np.zeros((self.width + 1, r.shape[1]))
        out[0] = r.sum(axis=0)
        for g in range(r.shape[1]):
            out[1:, g] = np.bincount(self.idx, self.val * r[self.row, g], self.width)
        return out

    def _dense(self) -> np.ndarray:
        u = np.zeros((self.n, self.width + 1))
        u[:, 0] = 1.0
        np.add.at(u, (self.row, self.idx + 1), self.val)
        return u

    def gram(self) -> np.ndarray:
        u = self._dense()
        return u.T @ u

    def squares(self) -> np.ndarray:
        return np.concatenate([[self.n], np.bincount(self.idx, self.val**2, self.width)])

    def pick(self, rows: np.ndarray) -> SparseBatch:
        where = np.flatnonzero(rows)
        lengths = np.diff(self.starts)[where]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        keep = rows[self.row]
        return SparseBatch(starts, self.idx[keep], self.val[keep], self.width, self.fold[where], self.y[where])


def _floats(column) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False)


@dataclass(frozen=True)
class DenseEncoding:
    """Layout of the encoded row: 1, numbers, number-missing flags, category flags, category-missing flags."""

    roles: Roles
    shifts: np.ndarray
    scales: np.ndarray
    missing_numbers: tuple[int, ...]
    vocab: tuple[tuple[str, ...], ...]
    missing_categories: tuple[int, ...]
    sparse: bool = field(default=False)

    @property
    def n_numbers(self) -> int:
        return len(self.shifts)

    @property
    def width(self) -> int:
        return 1 + self.n_numbers + len(self.missing_numbers) + sum(map(len, self.vocab)) + len(self.missing_categories)

    def batch(self, rb: pa.RecordBatch) -> DenseBatch:
        n = rb.num_rows
        u = np.zeros((n, self.width))
        u[:, 0] = 1.0
        at = 1
        if self.n_numbers:
            x = _floats(rb.column("num").flatten()).reshape(n, self.n_numbers)
            gone = np.isnan(x)
            u[:, 1 : 1 + self.n_numbers] = np.where(gone, 0.0, (x - self.shifts) / self.scales)
            at += self.n_numbers
            for j in self.missing_numbers:
                u[:, at] = gone[:, j]
                at += 1
        if self.vocab:
            codes = _floats(rb.column("cat").flatten()).reshape(n, len(self.vocab)).astype(np.int64)
            for j, words in enumerate(self.vocab):
                rows = np.flatnonzero((codes[:, j] >= 0) & (codes[:, j] < len(words)))
                u[rows, at + codes[rows, j]] = 1.0
                at += len(words)
            for j in self.missing_categories:
                u[:, at] = codes[:, j] < 0
                at += 1
        return DenseBatch(u, _floats(rb.column("fold")), _floats(rb.column("y")))


@dataclass(frozen=True)
class SparseEncoding:
    n_features: int
    sparse: bool = True

    @property
    def width(self) -> int:
        return 1 + self.n_features

    def batch(self, rb: pa.RecordBatch) -> SparseBatch:
        ind, val = rb.column("indices"), rb.column("values")
        starts = ind.offsets.to_numpy().astype(np.int64)
        return SparseBatch(
            starts - starts[0], _floats(ind.flatten()), _floats(val.flatten()), self.n_features,
            _floats(rb.column("fold")), _floats(rb.column("y")),
        )


def dense_encoding(df: DataFrame, roles: Roles) -> DenseEncoding:
    """Global shifts, scales and vocabularies. They only fix the layout and the
    numeric range of the encoding; what a fold learns comes from its own rows."""
    numbers = list(roles.numerical) + list(roles.other)
    shifts, scales = np.zeros(len(numbers)), np.ones(len(numbers))
    gone, n_rows = [], None
    if numbers:
        for r in numeric_statistics(df, numbers).collect():
            n_rows = r["n"]
            shifts[r["idx"]] = r["mean"] or 0.0
            scales[r["idx"]] = r["std"] or 1.0
            if r["n_present"] < n_rows:
                gone.append(r["idx"])
    n_rows = df.count() if n_rows is None else n_rows
    vocab: list[tuple[str, ...]] = [() for _ in roles.categorical]
    gone_cat = []
    if roles.categorical:
        counts = category_counts(df, roles.categorical).persist()
        n = counts.count()
        if n > MAX_CATEGORIES:
            raise DataFormatError(f"{n} categories in {list(roles.categorical)}: identifiers are not categories")
        rows = counts.groupBy("idx").agg(F.array_sort(F.collect_list("value")).alias("vs"), F.sum("n").alias("n")).collect()
        counts.unpersist()
        seen = {r["idx"]: r for r in rows}
        for j in range(len(roles.categorical)):
            r = seen.get(j)
            vocab[j] = tuple(r["vs"]) if r else ()
            if r is None or r["n"] < n_rows:
                gone_cat.append(j)
    return DenseEncoding(roles, shifts, scales, tuple(sorted(gone)), tuple(vocab), tuple(gone_cat))


def dense_rows(df: DataFrame, enc: DenseEncoding, y: str, fold: str, keep: Sequence[str] = ()) -> DataFrame:
    """``fold, y, num ARRAY<DOUBLE>, cat ARRAY<INT>``; NaN marks a missing number, -1 a missing category."""
    numbers = list(enc.roles.numerical) + list(enc.roles.other)
    cats = list(enc.roles.categorical)
    base = df
    if cats:
        named = [F.col(c).cast("string").alias(f"__c_{c}") for c in cats]
        base = df.select("*", *named)
        model = StringIndexerModel.from_arrays_of_labels(
            [list(v) or ["__none__"] for v in enc.vocab],
            inputCols=[f"__c_{c}" for c in cats],
            outputCols=[f"__i_{c}" for c in cats],
            handleInvalid="keep",
        )
        base = model.transform(base)
    nan = F.lit(float("nan"))
    num = F.array(*[F.coalesce(present(c), nan) for c in numbers]) if numbers else F.array().cast("array<double>")
    codes = [F.when(F.col(f"__c_{c}").isNull(), -1).otherwise(F.col(f"__i_{c}").cast("int")) for c in cats]
    cat = F.array(*codes) if codes else F.array().cast("array<int>")
    return base.select(
        *keep, F.col(fold).cast("int").alias("fold"), F.col(y).cast("double").alias("y"), num.alias("num"), cat.alias("cat")
    )


def sparse_rows(df: DataFrame, y: str, fold: str, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*keep, F.col(fold).cast("int").alias("fold"), F.col(y).cast("double").alias("y"), "indices", "values")


def sparse_vectors(df: DataFrame, n_features: int, keep: Sequence[str], scale: np.ndarray | None = None) -> DataFrame:
    """``indices, values`` as an MLlib vector, optionally scaled per column."""
    factors = None if scale is None else np.asarray(scale)

    @F.udf(returnType=VectorUDT())
    def build(ind, val):
        v = np.asarray(val, float) if factors is None else np.asarray(val, float) * factors[ind]
        return Vectors.sparse(n_features, ind, v)

    return df.select(*keep, build("indices", "values").alias("features"))


def bare(rows: DataFrame, *more: str) -> DataFrame:
    """What a batch is made of, and ``more``: a pass needs no other columns."""
    return rows.select(*(c for c in rows.columns if c in ("fold", "y", "u", "num", "cat", "indices", "values", *more)))


PACK_WIDTH = 64  # encoded columns up to which rows are packed
PACK_BYTES = 1 << 20


def packed(rows: DataFrame, enc) -> DataFrame:
    """The training rows of a narrow dense table in blocks of one fold: ``fold``, and ``u`` and ``y`` as bytes of float64.

    A pass then moves few large values instead of many small ones. Other tables stay as they are.
    """
    if enc.sparse or enc.width > PACK_WIDTH:
        return rows
    most = max(1, PACK_BYTES // (8 * enc.width))

    def run(it):
        held: dict[int, list] = {}

        def block(f):
            u, y = (np.concatenate(z) for z in zip(*held.pop(f)))
            return pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([u.tobytes()], pa.binary()), pa.array([y.tobytes()], pa.binary())], ["fold", "u", "y"])

        for b in batches(enc, it):
            for f in np.unique(b.fold).tolist():
                mine = b.fold == f
                held.setdefault(f, []).append((b.u[mine], b.y[mine]))
                if sum(len(y) for _, y in held[f]) >= most:
                    yield block(f)
        for f in list(held):
            yield block(f)

    return map_arrow(bare(rows.where(F.col("fold") != TEST)), run, "fold int, u binary, y binary")


def batches(enc, it: Iterator[pa.RecordBatch]):
    """Encoded batches of rows, or of ``packed`` ones."""
    for rb in it:
        if "u" in rb.schema.names:
            for f, u, y in zip(*(rb.column(c) for c in ("fold", "u", "y"))):
                y = np.frombuffer(y.as_buffer(), float)
                yield DenseBatch(np.frombuffer(u.as_buffer(), float).reshape(len(y), enc.width), np.full(len(y), f.as_py()), y)
        elif rb.num_rows:
            yield enc.batch(rb)


def slices(enc, it: Iterator[pa.RecordBatch], most: int):
    """The same, dense ones of some ``most`` rows."""
    most = max(256, most)
    for b in batches(enc, it):
        if b.n <= most or not isinstance(b, DenseBatch):
            yield b
            continue
        for a in range(0, b.n, most):
            yield DenseBatch(b.u[a : a + most], b.fold[a : a + most], b.y[a : a + most])


def _down(a: np.ndarray, like: np.ndarray) -> np.ndarray:
    """A value per row, shaped to multiply ``like``."""
    return a.reshape(-1, *[1] * (like.ndim - 1))


@dataclass
class FeatureMap:
    """prepared = const + scale * encoded[own] + flag_scale * encoded[flag], for one training subset."""

    encoded: int
    names: list[str]
    own: np.ndarray
    scale: np.ndarray
    const: np.ndarray
    flag: np.ndarray
    flag_scale: np.ndarray

    @property
    def width(self) -> int:
        return len(self.own)

    @cached_property
    def matrix(self) -> np.ndarray:
        """The same as prepared = encoded @ matrix.T."""
        out = np.zeros((self.width, self.encoded))
        at = np.arange(self.width)
        out[at, self.own] = self.scale
        out[at, self.flag] += self.flag_scale
        out[:, 0] += self.const
        return out

    def pull(self, w: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Weights on prepared features as weights on the encoded row."""
        out = np.zeros((self.encoded, *w.shape[1:]))
        out[self.own] = _down(self.scale, w) * w
        np.add.at(out, self.flag, _down(self.flag_scale, w) * w)
        out[0] += self.const @ w + b
        return out

    def push(self, g: np.ndarray) -> np.ndarray:
        """Gradient on the encoded row as (intercept; weights) on prepared features."""
        own = _down(self.const, g) * g[0] + _down(self.scale, g) * g[self.own] + _down(self.flag_scale, g) * g[self.flag]
        return np.concatenate([g[:1], own])

    def second(self, total: np.ndarray, square: np.ndarray) -> np.ndarray:
        """Squared sums of prepared features from the encoded columns' sums and squared sums.

        A prepared feature mixes encoded columns that are never non-zero together
        (a number and its missing flag; a category and the missing flag).
        """
        mixed = self.scale * total[self.own] + self.flag_scale * total[self.flag]
        return self.scale**2 * square[self.own] + self.flag_scale**2 * square[self.flag] + 2 * self.const * mixed + self.const**2 * total[0]

    def rows(self, batch: DenseBatch) -> np.ndarray:
        """Prepared features of a batch."""
        x = batch.u[:, self.own] * self.scale + self.const
        some = np.flatnonzero(self.flag_scale)
        x[:, some] += batch.u[:, self.flag[some]] * self.flag_scale[some]
        return x

    def with_one(self) -> np.ndarray:
        top = np.zeros((1, self.encoded))
        top[0, 0] = 1.0
        return np.vstack([top, self.matrix])


class DiagonalMap:
    """The same for max-abs scaled sparse rows, without a dense matrix."""

    def __init__(self, scale: np.ndarray):
        self.scale = scale
        self.width = len(scale)
        self.encoded = len(scale) + 1
        self.own, self.flag = np.arange(1, self.encoded), np.zeros(self.width, int)

    @property
    def matrix(self) -> np.ndarray:
        m = np.zeros((self.width, self.width + 1))
        m[np.arange(self.width), np.arange(self.width) + 1] = self.scale
        return m

    def pull(self, w, b):
        return np.vstack([np.atleast_2d(b), self.scale[:, None] * w])

    def push(self, g):
        return np.vstack([g[:1], self.scale[:, None] * g[1:]])

    def second(self, total, square):
        return self.scale**2 * square[1:]

    def rows(self, batch: SparseBatch) -> np.ndarray:
        return batch._dense()[:, 1:] * self.scale

    def with_one(self):
        return np.vstack([np.eye(1, self.width + 1), self.matrix])


def dense_map(enc: DenseEncoding, sums: np.ndarray, squares: np.ndarray) -> FeatureMap:
    """The preparation a subset learns, from its column sums and squared sums."""
    n = sums[0]
    numbers = list(enc.roles.numerical) + list(enc.roles.other)
    flag_at = {j: 1 + enc.n_numbers + i for i, j in enumerate(enc.missing_numbers)}
    scaled, plain, cats = [], [], []  # (name, own, scale, const, flag, flag_scale)
    for j, name in enumerate(numbers):
        if j >= len(enc.roles.numerical):
            plain.append((name, 1 + j, enc.scales[j], enc.shifts[j], 0, 0.0))
            continue
        gone = sums[flag_at[j]] if j in flag_at else 0.0
        if n - gone <= 0:
            continue
        mean = sums[1 + j] / (n - gone)
        var = (squares[1 + j] + gone * mean * mean) / n - mean * mean
        std = np.sqrt(var) if var > 1e-12 else 1.0
        scaled.append((name, 1 + j, 1 / std, -mean / std, flag_at.get(j, 0), mean / std if j in flag_at else 0.0))
    at = 1 + enc.n_numbers + len(enc.missing_numbers)
    gone_at = at + sum(map(len, enc.vocab))
    flag_at = {j: gone_at + i for i, j in enumerate(enc.missing_categories)}
    for j, words in enumerate(enc.vocab):
        counts = sums[at : at + len(words)]
        mode = int(np.argmax(counts)) if len(words) else -1
        for c, word in enumerate(words):
            if counts[c] > 0:
                filled = c == mode and j in flag_at
                cats.append((f"{enc.roles.categorical[j]}={word}", at + c, 1.0, 0.0, flag_at[j] if filled else 0, float(filled)))
        at += len(words)
    every = scaled + cats + plain
    cols = [np.array([x[i] for x in every], kind) for i, kind in ((1, int), (2, float), (3, float), (4, int), (5, float))]
    return FeatureMap(enc.width, [x[0] for x in every], *cols)


def learned_preparation(enc: DenseEncoding, sums: np.ndarray, squares: np.ndarray) -> Preparation:
    """The same preparation as column expressions, for learners that take MLlib vectors."""
    n = sums[0]
    means, stds, modes, cats = {}, {}, {}, {}
    flag_at = {j: 1 + enc.n_numbers + i for i, j in enumerate(enc.missing_numbers)}
    for j, name in enumerate(enc.roles.numerical):
        gone = sums[flag_at[j]] if j in flag_at else 0.0
        if n - gone <= 0:
            continue
        mean = sums[1 + j] / (n - gone)
        var = (squares[1 + j] + gone * mean * mean) / n - mean * mean
        means[name] = float(enc.shifts[j] + enc.scales[j] * mean)
        stds[name] = float(enc.scales[j] * np.sqrt(var)) if var > 1e-12 else 0.0
    at = 1 + enc.n_numbers + len(enc.missing_numbers)
    for j, words in enumerate(enc.vocab):
        counts = sums[at : at + len(words)]
        at += len(words)
        if len(words) and counts.max() > 0:
            name = enc.roles.categorical[j]
            modes[name] = words[int(np.argmax(counts))]
            cats[name] = [w for w, c in zip(words, counts) if c > 0]
    return Preparation(enc.roles, means, stds, modes, cats)
