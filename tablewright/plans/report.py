"""Leaderboard tables: pick winners and summarise scores, as DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tablewright.functions.missing import nan_to_null


def best_models(scores: DataFrame, by: Sequence[str] = ("dataset",)) -> DataFrame:
    """Per group the row of the highest ``cv_score``; ties keep the lower
    ``roster_order``, NaN and failed (null) scores never win."""
    valid = scores.withColumn("cv_score", nan_to_null(F.col("cv_score"))).where(F.col("cv_score").isNotNull())
    top = F.max_by(F.struct("model", "roster_order", "cv_score"), F.struct("cv_score", -F.col("roster_order")))
    return valid.groupBy(*by).agg(top.alias("b")).select(*by, "b.*")


def mean_fold_scores(fold_scores: DataFrame, by: Sequence[str]) -> DataFrame:
    """Unweighted mean of the fold scores per grid point."""
    return fold_scores.groupBy(*by).agg(F.avg("score").alias("cv_score"))
