"""Finding datasets in a folder tree of the three-file layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

REQUIRED = ("data", "solution")
# a part is a plain file ``<name>/<name>.data`` or one inside a folder of that name
LAYOUT = r"/([^/]+)/\1\.(data|solution|type)(?:/[^/]*)?$"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def list_parts(spark: SparkSession, root: str) -> DataFrame:
    """``dataset, part, bytes``; only names and lengths are read, never content."""
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    return listing.select(
        F.regexp_extract("path", LAYOUT, 1).alias("dataset"),
        F.regexp_extract("path", LAYOUT, 2).alias("part"),
        F.col("length").alias("bytes"),
    ).where(F.col("dataset") != "")


def discover(spark: SparkSession, root: str, dataset: str | None = None) -> DataFrame:
    """One row per dataset folder with the parts it has and whether it is complete."""
    parts = list_parts(spark, root)
    if dataset is not None:
        parts = parts.where(F.col("dataset") == dataset)
    has = lambda p: F.bool_or(F.col("part") == p)
    found = parts.groupBy("dataset").agg(
        has("data").alias("has_data"),
        has("solution").alias("has_solution"),
        has("type").alias("has_type"),
        F.sum("bytes").alias("bytes"),
    )
    return found.withColumn("complete", F.col("has_data") & F.col("has_solution")).orderBy("dataset")


def complete_datasets(spark: SparkSession, root: str, dataset: str | None = None) -> DataFrame:
    return discover(spark, root, dataset).where("complete").select("dataset", "has_type", "bytes")
