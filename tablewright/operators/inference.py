"""Classification or regression, decided from the target values alone.

The thresholds end at 100 distinct values, so exact counting of a continuous
target is never needed: an approximate count in the same pass as the other
statistics rules it out, and only small targets are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.errors import EmptyDataError
from tablewright.functions.missing import is_integral, missing_number

CLASSIFICATION, REGRESSION = "classification", "regression"
SURELY_MANY = 5_000


def _number(y: str) -> Column:
    return F.when(~missing_number(F.col(y).cast("double")), F.col(y).cast("double"))


def _statistics(exact: bool) -> list[Column]:
    """Aggregates over a column ``v``, null where missing."""
    count = F.count_distinct(F.col("v")) if exact else F.approx_count_distinct(F.col("v"))
    return [
        F.count("*").alias("n"),
        (F.count("*") - F.count("v")).alias("n_missing"),
        count.alias("n_distinct"),
        F.coalesce(F.bool_and(is_integral(F.col("v")) | F.col("v").isNull()), F.lit(True)).alias("all_integral"),
        F.min("v").alias("lowest"),
        F.max("v").alias("highest"),
    ]


def target_statistics(df: DataFrame, y: str, exact: bool = True) -> DataFrame:
    """One row: n, n_missing, n_distinct (missing values excluded), all_integral, lowest, highest.

    ``exact=False`` estimates the distinct count, in a single pass without a shuffle by value.
    """
    return df.select(_number(y).alias("v")).agg(*_statistics(exact))


def infer_task_tables(df: DataFrame, targets: dict[str, bool], rule: str = "main") -> DataFrame:
    """The statistics and the task of several numeric targets (name -> integer typed) from one scan; ``target`` names them."""
    cells = F.array(*[F.struct(F.lit(y).alias("target"), F.lit(integer).alias("integer"), _number(y).alias("v")) for y, integer in targets.items()])
    stats = df.select(F.inline(cells)).groupBy("target", "integer").agg(*_statistics(True))
    return stats.withColumn("task", task_rule(rule, F.col("integer"))).drop("integer")


def task_rule(rule: str, integer: Column) -> Column:
    """Decision over ``target_statistics`` columns. Rules: main, simple, strict."""
    n, missing, k = F.col("n"), F.col("n_missing"), F.col("n_distinct")
    integral, low, high = F.col("all_integral"), F.col("lowest"), F.col("highest")
    cls, reg = F.lit(CLASSIFICATION), F.lit(REGRESSION)
    if rule == "simple":
        return F.when(n == missing, reg).when(k <= 20, cls).otherwise(reg)
    if rule == "strict":
        return F.when(n == missing, reg).when((k <= 20) & integral, cls).otherwise(reg)
    if rule != "main":
        raise ValueError(f"unknown rule {rule}")
    # every missing value together counts as one more distinct value here
    kk = k + F.when(missing > 0, 1).otherwise(0)
    typed = integer & (missing == 0)
    run = (high - low + 1 == k) & (low >= 0) & (high < 100)
    return (
        F.when(n == missing, reg)
        .when(kk < 10, cls)
        .when(typed & (kk < 50), cls)
        .when(typed & run, cls)
        .when(integral & (missing == 0) & (kk < 20), cls)
        .otherwise(reg)
    )


def infer_task_table(df: DataFrame, y: str, rule: str = "main", integer: bool | None = None,
                     exact: bool = True) -> DataFrame:
    """The statistics with the decided task, lazily."""
    if integer is None:
        integer = dict(df.dtypes)[y] in ("tinyint", "smallint", "int", "bigint")
    stats = target_statistics(df, y, exact)
    return stats.withColumn("task", task_rule(rule, F.lit(integer)))


def infer_task(df: DataFrame, y: str, rule: str = "main", integer: bool | None = None) -> str:
    """The task as a value. Array targets are classification."""
    if dict(df.dtypes)[y].startswith("array"):
        return CLASSIFICATION
    rough = infer_task_table(df, y, rule, integer, exact=False).first()
    if rough["n"] == 0:
        if rule == "main":
            raise EmptyDataError("target is empty")
        return REGRESSION
    if rough["n_distinct"] > SURELY_MANY:
        return rough["task"]
    return infer_task_table(df, y, rule, integer).first()["task"]
