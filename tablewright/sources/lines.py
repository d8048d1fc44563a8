"""Text lines with a dense, position-based row number.

A split of a text file is read front to back by one task. The row number is
the count of lines in all earlier splits plus the position inside the split.
Both come from the scan itself (``_metadata`` and the per-task increasing id),
so the only extra work is one count per split; no row is shuffled or sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F


def text_lines(spark: SparkSession, path: str, skip_blank: bool = True) -> DataFrame:
    """``file, block, value`` for every line, blank ones dropped on request."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.trim(F.regexp_replace("value", r"[\s ]+", " ")).alias("value"),
    )
    return raw.where(F.col("value") != "") if skip_blank else raw


def numbered(name: str) -> Column:
    """A file name that sorts by the numbers in it: every run of digits padded to twenty."""
    padded = F.regexp_replace(name, r"(\d+)", "0" * 20 + "$1")
    return F.regexp_replace(padded, r"\d*(\d{20})(?!\d)", "$1")


def indexed_lines(spark: SparkSession, path: str, skip_blank: bool = True) -> DataFrame:
    """``row_id BIGINT, value STRING`` in file order (numbers in the file name, then the name, then the offset)."""
    here = text_lines(spark, path, skip_blank).withColumn("seq", F.monotonically_increasing_id())
    per_split = here.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    # one row per file split, never one per data row
    before = W.orderBy(numbered("file"), "file", "block").rowsBetween(W.unboundedPreceding, -1)
    offsets = per_split.select(
        "file",
        "block",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first_seq")).alias("shift"),
    )
    return here.join(offsets, ["file", "block"]).select((F.col("seq") + F.col("shift")).alias("row_id"), "value")


def tokens(value: Column) -> Column:
    return F.split(value, " ")
