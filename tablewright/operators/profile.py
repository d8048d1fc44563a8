"""Dataset profile: shape, sparsity, missing share, class balance.

Narrow tables are profiled by one aggregate without a shuffle of rows; very
wide ones are melted to (idx, value) first, so the plan does not grow with the
number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.bands import imbalance_level, percent_text, treatment_label
from tablewright.functions.missing import missing_number
from tablewright.functions.roles import CATEGORICAL, NUMERICAL, OTHER, role_of

MELT_ABOVE = 1000


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("bigint")


def _is_zero(df: DataFrame, c: str) -> Column:
    return F.col(c) == 0 if dict(df.dtypes)[c] != "string" else F.lit(False)


def _is_missing(df: DataFrame, c: str) -> Column:
    return missing_number(F.col(c)) if dict(df.dtypes)[c] in ("double", "float") else F.col(c).isNull()


def melt_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = F.array(*[F.col(c).cast("double") for c in columns])
    return df.select(F.posexplode(cells).alias("idx", "val"))


def dense_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: n_samples, n_features, zero_cells, missing_cells."""
    d = len(columns)
    if d <= MELT_ABOVE:
        zeros = reduce(lambda a, b: a + b, [_flag(_is_zero(df, c)) for c in columns])
        missing = reduce(lambda a, b: a + b, [_flag(_is_missing(df, c)) for c in columns])
        return df.agg(
            F.count("*").alias("n_samples"),
            F.lit(d).cast("bigint").alias("n_features"),
            F.coalesce(F.sum(zeros), F.lit(0)).alias("zero_cells"),
            F.coalesce(F.sum(missing), F.lit(0)).alias("missing_cells"),
        )
    long = melt_numeric(df, columns)
    return long.agg(
        (F.count("*") / d).cast("bigint").alias("n_samples"),
        F.lit(d).cast("bigint").alias("n_features"),
        F.sum(_flag(F.col("val") == 0)).alias("zero_cells"),
        F.sum(_flag(missing_number(F.col("val")))).alias("missing_cells"),
    )


def dense_shape(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    c = dense_cells(df, columns)
    cells = F.col("n_samples") * F.col("n_features")
    return c.select(
        "n_samples",
        "n_features",
        F.coalesce(F.try_divide("zero_cells", cells), F.lit(0.0)).alias("sparsity"),
        F.coalesce(F.try_divide("missing_cells", cells), F.lit(0.0)).alias("missing"),
    )


def sparse_shape(rows: DataFrame, n_features: int | None = None) -> DataFrame:
    """Shape of ``indices, values`` rows; stored zeros do not count as values."""
    nnz = F.size(F.filter("values", lambda v: v != 0)).cast("bigint")
    s = rows.agg(
        F.count("*").alias("n_samples"),
        (F.lit(n_features).cast("bigint") if n_features is not None
         else (F.max(F.array_max("indices")) + 1).cast("bigint")).alias("n_features"),
        F.sum(nnz).alias("nnz"),
    )
    density = F.try_divide("nnz", F.col("n_samples") * F.col("n_features"))
    return s.select(
        "n_samples",
        "n_features",
        (1 - density).alias("sparsity"),
        density.alias("density"),
        F.lit(0.0).alias("missing"),
    )


def valid_targets(df: DataFrame, y: str) -> DataFrame:
    c = F.col(y)
    keep = ~missing_number(c) if dict(df.dtypes)[y] in ("double", "float") else c.isNotNull()
    return df.where(keep)


def class_counts(df: DataFrame, y: str) -> DataFrame:
    """``label, n`` over the non-missing targets."""
    return valid_targets(df, y).groupBy(F.col(y).alias("label")).agg(F.count("*").alias("n"))


def class_count_map(df: DataFrame, y: str) -> DataFrame:
    """The same as one row holding a map; only for targets known to be classes."""
    pairs = F.array_sort(F.collect_list(F.struct("label", "n")))
    return class_counts(df, y).agg(F.map_from_entries(pairs).alias("class_distribution"))


def class_balance(df: DataFrame, y: str) -> DataFrame:
    """One row: n_classes, imbalance_ratio, imbalance, level."""
    c = class_counts(df, y).agg(
        F.count("*").alias("n_classes"), F.max("n").alias("biggest"), F.min("n").alias("smallest")
    )
    ratio = F.try_divide("biggest", "smallest")
    return c.select(
        "n_classes",
        F.when(F.col("n_classes") > 1, ratio).alias("imbalance_ratio"),
        F.when(F.col("n_classes") > 1, 1 - F.try_divide("smallest", "biggest"))
        .otherwise(F.lit(0.0))
        .alias("imbalance"),
        imbalance_level(ratio, F.col("n_classes")).alias("imbalance_level"),
    )


def display_profile(profile: DataFrame) -> DataFrame:
    """Fixed column order with percentages as text."""
    is_cls = F.col("task") == "classification"
    return profile.select(
        F.col("dataset").alias("Dataset"),
        "n_samples",
        "n_features",
        percent_text(F.col("sparsity"), 2).alias("Sparsité"),
        percent_text(F.col("missing"), 1).alias("Missing"),
        F.when(is_cls, F.col("n_classes").cast("string")).otherwise("N/A").alias("n_classes"),
        F.when(is_cls, F.col("imbalance_level")).otherwise("N/A").alias("Imbalance"),
        treatment_label(F.col("is_sparse"), F.col("n_categorical")).alias("Pipeline Type"),
    )


def rounded_profile(profile: DataFrame) -> DataFrame:
    """The file profiler's numeric form: percentages to two places, imbalance to four."""
    return profile.select(
        "dataset",
        "n_samples",
        "n_features",
        F.round(F.col("sparsity") * 100, 2).alias("sparsity_pct"),
        F.round(F.col("missing") * 100, 2).alias("missing_pct"),
        "n_classes",
        F.round("imbalance", 4).alias("imbalance"),
    )


def global_statistics(profile: DataFrame) -> DataFrame:
    return profile.agg(
        F.sum("n_samples").alias("total_samples"),
        F.avg("n_features").alias("avg_features"),
        F.count_if(F.col("task") == "classification").alias("n_classification"),
        F.count_if(F.col("task") != "classification").alias("n_regression"),
    )


def treatment_distribution(profile: DataFrame) -> DataFrame:
    label = treatment_label(F.col("is_sparse"), F.col("n_categorical"))
    return (
        profile.groupBy(label.alias("treatment"))
        .agg(F.count("*").alias("n_datasets"))
        .orderBy(F.desc("n_datasets"), "treatment")
    )


def role_counts(types: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of numerical, categorical and other features from a ``type`` column."""
    role = role_of(F.col("type"))
    return types.groupBy(*keys).agg(
        F.count("*").alias("n_types"),
        F.count_if(role == NUMERICAL).alias("numerical_features"),
        F.count_if(role == CATEGORICAL).alias("categorical_features"),
        F.count_if(role == OTHER).alias("unknown_features"),
    )


def preparation_summary(types: DataFrame, shapes: DataFrame, keys: Sequence[str] = ("dataset",)) -> DataFrame:
    """Which treatment each dataset gets; ``shapes`` holds n_features and is_sparse."""
    joined = shapes.join(role_counts(types, keys), list(keys), "left")
    typed = F.coalesce(F.col("n_types") == F.col("n_features"), F.lit(False)) & ~F.col("is_sparse")
    impute_scale = "Imputation (mean) + StandardScaler"
    return joined.select(
        *keys,
        F.when(F.col("is_sparse"), "sparse").otherwise("dense").alias("data_type"),
        F.when(typed, F.col("numerical_features"))
        .when(~F.col("is_sparse"), F.col("n_features"))
        .alias("numerical_features"),
        F.when(typed, F.col("categorical_features")).alias("categorical_features"),
        F.when(typed, F.col("unknown_features")).alias("unknown_features"),
        F.when(F.col("is_sparse"), "MaxAbsScaler only").otherwise(impute_scale).alias("numerical_preprocessing"),
        F.when(typed, "Imputation (most frequent) + OneHotEncoder").alias("categorical_preprocessing"),
    )


def dataset_profile(df: DataFrame, name: str, columns: Sequence[str], y: str, task: str,
                    n_categorical: int = 0, is_sparse: bool = False, n_features: int | None = None) -> DataFrame:
    """One row per dataset; ``display_profile`` and ``rounded_profile`` render it."""
    shape = (sparse_shape(df, n_features).drop("density") if is_sparse else dense_shape(df, columns))
    balance = class_balance(df, y)
    # both sides are a single row
    return shape.withColumn("k", F.lit(1)).join(balance.withColumn("k", F.lit(1)), "k").select(
        F.lit(name).alias("dataset"),
        F.lit(task).alias("task"),
        "n_samples",
        "n_features",
        "sparsity",
        "missing",
        "n_classes",
        "imbalance_ratio",
        "imbalance",
        "imbalance_level",
        F.lit(is_sparse).alias("is_sparse"),
        F.lit(n_categorical).cast("bigint").alias("n_categorical"),
    )
