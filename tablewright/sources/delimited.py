"""Delimiter-sniffing reader, libsvm reader and the last-column target."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession, functions as F

# Delimiters in the order they are tried.
DELIMITERS = (",", "\t", ";", " ")


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """First delimiter that gives more than one column; otherwise the last one.

    The first line fixes a header-less file's width, so it decides; it is parsed,
    so a delimiter inside quotes does not count.
    """
    first = spark.read.text(path).where(F.trim("value") != "").first()
    if first is None:
        return DELIMITERS[-1]
    return next((d for d in DELIMITERS if len(next(csv.reader([first[0]], delimiter=d))) > 1), DELIMITERS[-1])


def read_delimited(spark: SparkSession, path: str, infer: bool = True) -> DataFrame:
    sep = sniff_delimiter(spark, path)
    return (
        spark.read.option("header", "false").option("sep", sep).option("inferSchema", str(infer).lower()).csv(path)
    )


def split_last_column(df: DataFrame) -> tuple[list[str], str]:
    """Names of the feature columns and of the target."""
    return df.columns[:-1], df.columns[-1]


def last_column_target(df: DataFrame, features: str = "x", target: str = "y") -> DataFrame:
    xs, y = split_last_column(df)
    return df.select(F.array(*[F.col(c).cast("double") for c in xs]).alias(features), F.col(y).alias(target))


def is_labelled_sparse(spark: SparkSession, path: str) -> bool:
    """Whether every line is a number and ``idx:val`` pairs, with a pair somewhere."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    number = r"[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?"
    fits = F.trim("value").rlike(rf"^{number}(\s+\d+:{number})*$")
    found = lines.agg(F.bool_and(fits).alias("all"), F.bool_or(F.col("value").contains(":")).alias("pairs")).first()
    return bool(found["all"] and found["pairs"])


def read_libsvm(spark: SparkSession, path: str, n_features: int | None = None) -> DataFrame:
    """``label DOUBLE, features VECTOR``; the width is found by a pass when not given."""
    reader = spark.read.format("libsvm")
    if n_features is not None:
        reader = reader.option("numFeatures", str(n_features))
    return reader.load(path)
