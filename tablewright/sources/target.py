"""Target and feature-type files, and labels from a raw target."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.errors import DataFormatError, EmptyDataError
from tablewright.functions.labels import first_argmax, sums_to_one
from tablewright.functions.missing import INTEGER, is_number, parse_number
from tablewright.sources.lines import indexed_lines, text_lines, tokens


@dataclass(frozen=True)
class Target:
    """``row_id, y``: DOUBLE for one column or a one-hot label, else ARRAY<DOUBLE>."""

    df: DataFrame
    n_columns: int
    one_hot: bool
    integer: bool

    @property
    def multi_column(self) -> bool:
        return self.n_columns > 1 and not self.one_hot


def parse_target(lines: DataFrame) -> DataFrame:
    return lines.select("row_id", F.transform(tokens(F.col("value")), parse_number).alias("y"))


def flat_target(rows: DataFrame, y: str = "y") -> DataFrame:
    """The first value of a one-column target in place of its array."""
    return rows.withColumn(y, F.get(y, F.lit(0)))


def read_target(spark: SparkSession, path: str) -> Target:
    """One column gives a flat target. Several columns whose rows all sum to one
    give the position of the first maximum; anything else stays an array."""
    plain = text_lines(spark, path)
    tok = tokens(F.col("value"))
    nums = F.transform(tok, parse_number)
    seen = plain.agg(
        F.max(F.size(tok)).alias("w"),
        F.min(F.size(tok)).alias("w_min"),
        F.bool_and(F.coalesce(sums_to_one(nums), F.lit(False))).alias("ones"),
        F.bool_and(F.forall(tok, lambda t: t.rlike(INTEGER))).alias("ints"),
        F.bool_and(F.forall(tok, is_number)).alias("numeric"),
    ).first()
    if seen["w"] is None:
        raise EmptyDataError(f"no rows in {path}")
    if seen["w"] != seen["w_min"]:
        raise DataFormatError(f"{path}: rows have between {seen['w_min']} and {seen['w']} columns")
    if not seen["numeric"]:
        raise DataFormatError(f"{path}: the target holds text; index it first")
    rows = parse_target(indexed_lines(spark, path))
    one_hot = seen["w"] > 1 and seen["ones"]
    if seen["w"] == 1:
        rows = flat_target(rows)
    elif one_hot:
        rows = rows.select("row_id", first_argmax(F.col("y")).cast("double").alias("y"))
    return Target(rows, seen["w"], one_hot, bool(seen["ints"]) or one_hot)


def read_types(spark: SparkSession, path: str) -> DataFrame:
    """``feature_idx, type`` for every non-blank line."""
    return indexed_lines(spark, path).select(
        F.col("row_id").alias("feature_idx"), F.col("value").alias("type")
    )


def load_types(spark: SparkSession, path: str) -> list[str] | None:
    """One short line per feature, so the list is as small as the schema; None without a file."""
    from tablewright.sources.discovery import exists

    if not exists(spark, path):
        return None
    return [r["type"] for r in read_types(spark, path).orderBy("feature_idx").collect()]
