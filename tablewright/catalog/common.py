"""Shared table access for the queries, and the matching SQL fragments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "cents"]
KEY_SQL = ", ".join(KEYS)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """``cents`` completes the row key."""
    return table(spark, sf, "lineitem").withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))


def with_gaps(df: DataFrame) -> DataFrame:
    """Missing numbers and categories, placed by key."""
    return df.withColumn("x_discount", F.when(F.col("cents") % 7 != 0, F.col("l_discount"))).withColumn(
        "x_status", F.when(F.col("cents") % 11 != 0, F.col("l_linestatus"))
    )


def hash_sql(keys: str) -> str:
    parts = ", ".join(f"{k.strip()}::varchar" for k in keys.split(","))
    return f"('0x' || substr(md5(concat_ws('|', {parts}, '42')), 1, 8))::bigint"


LI = f"""li as (
  select *, {hash_sql(KEY_SQL)} as h,
    case when cents % 7 <> 0 then l_discount end as x_discount,
    case when cents % 11 <> 0 then l_linestatus end as x_status
  from (select *, cast(round(l_extendedprice * 100) as bigint) as cents from lineitem))"""


class Registry:
    """Collects the queries of a module: ``@reg("name", sql)``."""

    def __init__(self):
        self.queries: dict[str, Callable] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, name: str, sql: str | None = None):
        def add(fn):
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return add
