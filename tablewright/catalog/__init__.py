"""Every operator as a query over the Parquet tables, with its SQL twin where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablewright.catalog import choose, evaluate, files, models, prepare, profile, targets

MODULES = (files, targets, profile, prepare, models, choose, evaluate)
Query = Callable[[SparkSession, str], DataFrame]


def all_queries() -> dict[str, Query]:
    return {k: q for m in MODULES for k, q in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
