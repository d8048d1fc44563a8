"""The file profiler: labelled-sparse first, then delimited text, then one rounded row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.functions.missing import parse_number
from tablewright.operators.profile import class_balance, dense_shape, rounded_profile, sparse_shape
from tablewright.sources.delimited import is_labelled_sparse, read_delimited, split_last_column
from tablewright.sources.discovery import exists
from tablewright.sources.lines import indexed_lines
from tablewright.sources.matrix import parse_sparse


def profile_file(spark: SparkSession, path: str, solution: str | None = None) -> DataFrame:
    """One row: dataset, n_samples, n_features, sparsity_pct, missing_pct, n_classes, imbalance.

    A file whose lines are all ``label idx:val ...`` is sparse with its own labels.
    Any other file is delimited text; its target is the solution file, if there is
    one, or else the last column. Missing targets are left out of the classes.
    """
    name = path.rstrip("/").rsplit("/", 1)[-1].split(".")[0]
    given = solution is not None and exists(spark, solution)
    if is_labelled_sparse(spark, path):
        lines = indexed_lines(spark, path)
        shape = sparse_shape(parse_sparse(lines.select("row_id", F.regexp_extract("value", r"^\S+ ?(.*)$", 1).alias("value"))))
        y = lines.select(parse_number(F.regexp_extract("value", r"^\S+", 0)).alias("y"))
    else:
        df = read_delimited(spark, path)
        features, last = (df.columns, None) if given else split_last_column(df)
        shape = dense_shape(df, features)
        y = None if given else df.select(parse_number(F.col(last).cast("string")).alias("y"))
    if given:
        t = read_delimited(spark, solution)
        y = t.select(F.explode(F.array(*[parse_number(F.col(c).cast("string")) for c in t.columns])).alias("y"))
    # two tables of one row
    one = shape.crossJoin(F.broadcast(class_balance(y, "y"))).withColumn("dataset", F.lit(name))
    return rounded_profile(one)


def profile_files(spark: SparkSession, files: dict[str, str | None]) -> DataFrame:
    """``profile_file`` of every path with its solution or None."""
    return reduce(lambda a, b: a.unionByName(b), [profile_file(spark, p, s) for p, s in files.items()])
