"""Feature preparation: impute, scale and one-hot, fitted on given rows only.

Fitting is one aggregate over the numeric columns and one grouped count over
all categorical columns melted together. Applying is a projection.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import (
    OneHotEncoder,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame, functions as F

from tablewright.errors import DataFormatError
from tablewright.functions.missing import missing_number
from tablewright.functions.roles import Roles
from tablewright.operators.profile import MELT_ABOVE, melt_numeric

MAX_CATEGORIES = 1_000_000


def present(c: str) -> Column:
    """DOUBLE with NaN as null."""
    x = F.col(c).cast("double")
    return F.when(~missing_number(x), x)


def numeric_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``idx, n, mean, std, n_present`` per numeric column; std as after mean imputation.

    Imputing the mean adds rows without spread, so the population variance
    shrinks by the share of present values.
    """
    if len(columns) <= MELT_ABOVE:
        aggs = []
        for c in columns:
            x = present(c)
            aggs.append(F.struct(F.avg(x).alias("mean"), F.var_pop(x).alias("var"), F.count(x).alias("n_present")).alias(c))
        one = df.agg(F.count("*").alias("n"), *aggs)
        rows = one.select("n", F.posexplode(F.array(*[F.col(c) for c in columns])).alias("idx", "s"))
        stats = rows.select("idx", "n", "s.*")
    else:
        long = melt_numeric(df, columns).select("idx", F.when(~missing_number(F.col("val")), F.col("val")).alias("val"))
        stats = long.groupBy("idx").agg(
            F.count("*").alias("n"), F.avg("val").alias("mean"), F.var_pop("val").alias("var"),
            F.count("val").alias("n_present"),
        )
    return stats.select(
        "idx", "n", "mean", F.sqrt(F.col("var") * F.try_divide("n_present", "n")).alias("std"), "n_present"
    )


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``idx, value, n`` over all categorical columns, null values left out."""
    cells = F.array(*[F.col(c).cast("string") for c in columns])
    return (
        df.select(F.posexplode(cells).alias("idx", "value"))
        .where(F.col("value").isNotNull())
        .groupBy("idx", "value")
        .agg(F.count("*").alias("n"))
    )


def modes(counts: DataFrame) -> DataFrame:
    """``idx, mode``: most frequent value, the smallest one on ties."""
    best = F.min(F.struct((-F.col("n")).alias("neg"), "value"))
    return counts.groupBy("idx").agg(best.alias("b")).select("idx", F.col("b.value").alias("mode"))


def ratio_or_zero(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


@dataclass(frozen=True)
class Preparation:
    """Fitted values per column. Columns without a single present value are dropped."""

    roles: Roles
    means: dict[str, float]
    stds: dict[str, float]
    modes: dict[str, str]
    categories: dict[str, list[str]]

    @property
    def numerical(self) -> list[str]:
        return [c for c in self.roles.numerical if c in self.means]

    @property
    def categorical(self) -> list[str]:
        return [c for c in self.roles.categorical if c in self.modes]

    @property
    def dropped(self) -> list[str]:
        return [c for c in self.roles.numerical if c not in self.means] + [
            c for c in self.roles.categorical if c not in self.modes
        ]

    def scaled(self, c: str, centre: bool = True) -> Column:
        """(x - mean) / std after imputation; a constant column becomes zero."""
        mean, std = self.means[c], self.stds[c] or 1.0
        filled = F.coalesce(present(c), F.lit(mean))
        return (filled - (mean if centre else 0.0)) / F.lit(std)

    def filled_category(self, c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))

    def one_hot(self, c: str) -> list[Column]:
        v = self.filled_category(c)
        return [(v == k).cast("double").alias(f"{c}={k}") for k in self.categories[c]]

    def columns(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Plain columns: scaled numbers, one flag per category, the rest as it is."""
        flags = [f for c in self.categorical for f in self.one_hot(c)]
        nums = [self.scaled(c).alias(c) for c in self.numerical]
        return df.select(*keep, *nums, *flags, *self.roles.other)

    def vectors(self, df: DataFrame, keep: Sequence[str] = (), out: str = "features") -> DataFrame:
        """One MLlib vector per row; unseen categories give zeros."""
        cats = self.categorical
        rest = [F.col(c).cast("double").alias(c) for c in self.roles.other]
        base = df.select(
            *keep,
            *[self.scaled(c).alias(f"__n_{c}") for c in self.numerical],
            *[self.filled_category(c).alias(f"__c_{c}") for c in cats],
            *rest,
        )
        inputs = [f"__n_{c}" for c in self.numerical]
        if cats:
            indexer = StringIndexerModel.from_arrays_of_labels(
                [self.categories[c] for c in cats],
                inputCols=[f"__c_{c}" for c in cats],
                outputCols=[f"__i_{c}" for c in cats],
                handleInvalid="keep",
            )
            # the dropped last slot is the bucket of unseen values
            encoder = OneHotEncoder(
                inputCols=[f"__i_{c}" for c in cats], outputCols=[f"__o_{c}" for c in cats], dropLast=True
            )
            indexed = indexer.transform(base)
            base = encoder.fit(indexed).transform(indexed)
            inputs += [f"__o_{c}" for c in cats]
        inputs += list(self.roles.other)
        return VectorAssembler(inputCols=inputs, outputCol=out).transform(base).select(*keep, out)


def fit_preparation(df: DataFrame, roles: Roles) -> Preparation:
    """Learn means, deviations, modes and categories from ``df``.

    What comes back to the driver is one row per column and one per category.
    """
    means, stds, top, cats = {}, {}, {}, {}
    if roles.numerical:
        for r in numeric_statistics(df, roles.numerical).collect():
            if r["n_present"]:
                c = roles.numerical[r["idx"]]
                means[c], stds[c] = r["mean"], r["std"]
    if roles.categorical:
        counts = category_counts(df, roles.categorical).persist()
        n = counts.count()
        if n > MAX_CATEGORIES:
            raise DataFormatError(f"{n} categories in {list(roles.categorical)}: identifiers are not categories")
        for r in modes(counts).collect():
            top[roles.categorical[r["idx"]]] = r["mode"]
        for r in counts.groupBy("idx").agg(F.array_sort(F.collect_list("value")).alias("vs")).collect():
            cats[roles.categorical[r["idx"]]] = list(r["vs"])
        counts.unpersist()
    return Preparation(roles, means, stds, top, cats)


def max_abs_scale(cells: DataFrame) -> DataFrame:
    """``row_id, idx, val`` scaled by the column's largest absolute value.

    The maxima are one row per column and are joined by ``idx``; Spark
    broadcasts them when they are small, and otherwise shuffles by column.
    """
    top = cells.groupBy("idx").agg(F.max(F.abs("val")).alias("top"))
    return cells.join(top, "idx").select("row_id", "idx", ratio_or_zero(F.col("val"), F.col("top")).alias("val"))


def scale_without_centering(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """x / std (population); a constant column is left as it is."""
    # one number per column
    stds = {r["idx"]: r["std"] or 1.0 for r in numeric_statistics(df, columns).collect()}
    return df.select(*keep, *[(F.col(c).cast("double") / F.lit(stds[i])).alias(c) for i, c in enumerate(columns)])


def impute_mean(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns without any value stay null."""
    means = {r["idx"]: r["mean"] for r in numeric_statistics(df, columns).collect()}
    return df.select(*keep, *[F.coalesce(present(c), F.lit(means[i]).cast("double")).alias(c) for i, c in enumerate(columns)])
