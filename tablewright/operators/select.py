"""Univariate feature scores and top-k selection, plus the large-data chain."""

from __future__ import annotations

from collections.abc import Sequence

from math import sqrt

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, UnivariateFeatureSelector
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F



def _melt_with(df: DataFrame, columns: Sequence[str], y: str) -> DataFrame:
    cells = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(F.col(y).alias("y"), F.posexplode(cells).alias("idx", "val"))


def anova_f(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    """``idx, f`` of the one-way analysis of variance.

    Counts, means and variances per (feature, class) are combined on the map
    side, so the shuffle carries features x classes rows.
    """
    by_class = (
        _melt_with(df, columns, label)
        .groupBy("idx", "y")
        .agg(F.count("val").alias("n"), F.avg("val").alias("m"), F.var_pop("val").alias("v"))
    )
    total = by_class.groupBy("idx").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("k"),
        F.try_divide(F.sum(F.col("n") * F.col("m")), F.sum("n")).alias("grand"),
        F.sum(F.col("n") * F.col("v")).alias("within"),
        F.collect_list(F.struct("n", "m")).alias("groups"),
    )
    between = F.aggregate(
        "groups", F.lit(0.0), lambda acc, g: acc + g["n"] * (g["m"] - F.col("grand")) * (g["m"] - F.col("grand"))
    )
    return total.select(
        "idx",
        F.try_divide(between / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k"))).alias("f"),
    )


def correlation_f(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """``idx, f`` = r²/(1-r²)·(n-2)."""
    stats = _melt_with(df, columns, target).groupBy("idx").agg(
        F.count("val").alias("n"), F.corr("val", F.col("y").cast("double")).alias("r")
    )
    r2 = F.col("r") * F.col("r")
    return stats.select("idx", (F.try_divide(r2, 1 - r2) * (F.col("n") - 2)).alias("f"))


def _cells(df: DataFrame, y: str) -> DataFrame:
    """One row per stored value of sparse rows."""
    return df.select(F.col(y).alias("y"), F.explode(F.arrays_zip("indices", "values")).alias("c")).select(
        "y", F.col("c.indices").alias("idx"), F.col("c.values").cast("double").alias("val"))


def sparse_anova_f(df: DataFrame, label: str) -> DataFrame:
    """``idx, f`` of the one-way analysis of variance of sparse rows (``indices, values``); what isn't stored is zero.

    Zeros add nothing to sums: a feature's sums per class over stored values and
    the classes' sizes give all of it. Sums combine on the map side; the shuffle
    carries features x classes rows, and the classes' sizes go to every task (their
    number is bounded where labels are read).
    """
    sizes = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("y")).agg(F.count(F.lit(1)).alias("rows"))
    n, k = sizes.agg(F.sum("rows"), F.count(F.lit(1))).first()
    sums = _cells(df, label).groupBy("idx", "y").agg(F.sum("val").alias("s"), F.sum(F.col("val") * F.col("val")).alias("q"))
    total = sums.join(F.broadcast(sizes), "y").groupBy("idx").agg(
        F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("rows")).alias("own"))
    between, within = F.col("own") - F.col("s") * F.col("s") / n, F.col("q") - F.col("own")
    return total.select("idx", F.try_divide(between / (k - 1), within / (n - k)).alias("f"))


def sparse_correlation_f(df: DataFrame, target: str) -> DataFrame:
    """``idx, f`` = r²/(1-r²)·(n-2) of sparse rows; what isn't stored is zero."""
    y = F.col(target).cast("double")
    n, mean, squares = df.where(y.isNotNull()).agg(F.count(y), F.avg(y), F.var_pop(y) * F.count(y)).first()
    sums = _cells(df.withColumn(target, y - F.lit(mean)), target).groupBy("idx").agg(
        F.sum("val").alias("s"), F.sum(F.col("val") * F.col("val")).alias("q"), F.sum(F.col("val") * F.col("y")).alias("p"))
    r2 = F.try_divide(F.col("p") * F.col("p"), (F.col("q") - F.col("s") * F.col("s") / n) * F.lit(squares))
    return sums.select("idx", (F.try_divide(r2, 1 - r2) * (n - 2)).alias("f"))


def top_features(scores: DataFrame, k: int) -> DataFrame:
    """The k best features; undefined scores rank last, ties keep column order."""
    return scores.orderBy(F.col("f").desc_nulls_last(), "idx").limit(k)


IS_TREE = ("DecisionTree", "RandomForest", "GBT")


class PopulationScaler(Estimator):
    """Scales by the population deviation, as all preparation here does; MLlib's scaler uses the sample's."""

    def __init__(self, column: str, output: str, centre: bool):
        super().__init__()
        self.column, self.output, self.centre = column, output, centre

    def _fit(self, df: DataFrame) -> PipelineModel:
        n = df.count()
        scaler = StandardScaler(inputCol=self.column, outputCol="__sample", withMean=self.centre, withStd=True).fit(df)
        factor = sqrt(n / (n - 1)) if n > 1 else 1.0
        return PipelineModel([scaler, ElementwiseProduct(scalingVec=Vectors.dense([factor] * scaler.std.size), inputCol="__sample", outputCol=self.output)])


def large_data_chain(estimator: Estimator, n_features: int, task: str, sparse: bool = False,
                     max_features: int = 1000, features: str = "features", label: str = "label") -> Pipeline:
    """[scale] + [keep the best ``max_features``] + estimator, for any MLlib estimator.

    Trees need no scaling; sparse vectors are scaled without centering.
    """
    stages, at = [], features
    if not type(estimator).__name__.startswith(IS_TREE):
        stages.append(PopulationScaler(at, "__scaled", centre=not sparse))
        at = "__scaled"
    if n_features > max_features:
        chooser = UnivariateFeatureSelector(
            featuresCol=at, labelCol=label, outputCol="__chosen", selectionMode="numTopFeatures"
        )
        chooser.setFeatureType("continuous")
        chooser.setLabelType("categorical" if task == "classification" else "continuous")
        chooser.setSelectionThreshold(max_features)
        stages.append(chooser)
        at = "__chosen"
    stages.append(estimator.copy().setFeaturesCol(at).setLabelCol(label))
    return Pipeline(stages=stages)
