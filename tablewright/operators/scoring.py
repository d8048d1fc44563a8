"""Fitted scorers and one-pass evaluation of many of them.

A scorer turns encoded rows into predictions. All scorers of all folds are
evaluated in one pass: a row is scored only by the models that did not train
on its fold, and each task emits one total per (model, fold).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.operators.design import bare, slices
from tablewright.session import map_arrow

KEYS = "__keys"  # of the equal rows that a row stands for (see trees.equal_rows)
TIMES = "__times"  # their number, where no tree needs their keys
BATCH_ROWS = 10_000
SIGN, ARGMAX, VALUE = "sign", "argmax", "value"


def _decide(scores: np.ndarray, rule: str) -> np.ndarray:
    if rule == SIGN:
        return (scores[:, 0] > 0).astype(float)
    if rule == ARGMAX:
        return scores.argmax(axis=1).astype(float)
    return scores[:, 0]


@dataclass
class LinearScorer:
    """Weights on the encoded row (first row: intercept), one column per output."""

    weights: np.ndarray
    rule: str

    def predict(self, batch) -> np.ndarray:
        return _decide(batch.times(self.weights), self.rule)


@dataclass
class QuadraticScorer:
    """const + X @ linear + X² @ quadratic on prepared features X."""

    matrix: np.ndarray
    linear: np.ndarray
    quadratic: np.ndarray
    const: np.ndarray

    def predict(self, batch) -> np.ndarray:
        x = batch.times(self.matrix.T)
        return _decide(self.const + x @ self.linear + (x * x) @ self.quadratic, ARGMAX)


def evaluate_scorers(rows: DataFrame, enc, scorers: dict[tuple[int, int], object], task: str) -> dict:
    """{(model, fold): mean score}: accuracy, or negative mean squared error.

    ``scorers`` is keyed by (model, fold the scorer is judged on). Rows with
    ``KEYS`` or ``TIMES`` stand for as many equal ones; ``packed`` rows are read as well.
    """
    shared = rows.sparkSession.sparkContext.broadcast(scorers)
    classify, grouped, counted = task == "classification", KEYS in rows.columns, TIMES in rows.columns
    folds = sorted({f for _, f in scorers})

    def score(it):
        total: dict[tuple[int, int], list[float]] = {}
        by_fold: dict[int, list] = {}
        for (m, f), s in shared.value.items():
            by_fold.setdefault(f, []).append((m, s))
        if counted:
            each = ((enc.batch(rb), rb.column(TIMES).to_numpy().astype(float)) for rb in it if rb.num_rows)
        elif grouped:
            each = ((enc.batch(rb), np.diff(rb.column(KEYS).offsets.to_numpy())) for rb in it if rb.num_rows)
        else:
            each = ((b, np.ones(b.n)) for b in slices(enc, it, BATCH_ROWS))
        for b, times in each:
            for f, models in by_fold.items():
                mine = b.fold == f
                if not mine.any():
                    continue
                part, w = (b, times) if mine.all() else (b.pick(mine), times[mine])
                n = float(w.sum())
                for m, s in models:
                    p = s.predict(part)
                    gain = float((w * (p == part.y)).sum()) if classify else -float((w * (p - part.y) ** 2).sum())
                    acc = total.setdefault((m, f), [0.0, 0.0])
                    acc[0] += n
                    acc[1] += gain
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
             pa.array([total[k][0] for k in keys], pa.float64()), pa.array([total[k][1] for k in keys], pa.float64())],
            ["model", "fold", "n", "gain"],
        )

    partials = map_arrow(bare(rows.where(F.col("fold").isin(*folds)), KEYS, TIMES), score, "model int, fold int, n double, gain double")
    got = partials.groupBy("model", "fold").agg((F.sum("gain") / F.sum("n")).alias("score")).collect()
    shared.unpersist()
    return {(r["model"], r["fold"]): r["score"] for r in got}


def predict_rows(rows: DataFrame, enc, scorer, keep: dict[str, str]) -> DataFrame:
    """``keep`` columns (name -> SQL type), y, prediction ``p``."""
    shared = rows.sparkSession.sparkContext.broadcast(scorer)
    names = list(keep)

    def run(it):
        for rb in it:
            if rb.num_rows:
                p = shared.value.predict(enc.batch(rb))
                yield pa.RecordBatch.from_arrays(
                    [rb.column(c) for c in names] + [rb.column("y"), pa.array(np.asarray(p, float))], [*names, "y", "p"]
                )

    schema = ", ".join([f"{c} {t}" for c, t in keep.items()] + ["y double", "p double"])
    return map_arrow(rows, run, schema)
