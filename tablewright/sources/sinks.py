"""Writers for result tables and for the text layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def write_profile_csv(profile: DataFrame, path: str) -> None:
    profile.write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).parquet(path)


def write_lines(df: DataFrame, line: Column, order: Sequence[str], path: str) -> None:
    """Lines in ``order``: a range-partitioned sort, so part names follow row order. No ``order``: ``df`` is sorted already."""
    (df.orderBy(*order) if order else df).select(line.alias("value")).write.text(path)


def dense_line(columns: Sequence[str | Column]) -> Column:
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws(" ", *[F.coalesce(c.cast("string"), F.lit("NaN")) for c in cols])
