"""Exact deduplication by a 128-bit content hash, with the bytes compared inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import documents, id_and_text, keep_marked, text_key
from tablewright.session import materialize


def normalised(text: Column) -> Column:
    """Every run of blanks, tabs and line ends as one space; single spaces are left alone without a match."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def content_hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def digests(docs: DataFrame, hashed: Callable[[Column], Column] = content_hash, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 and text_key.

    Rows are grouped by hash; texts of one hash are compared byte by byte, and
    where they differ the hash is told apart by a variant number. The row with
    the smallest id stays; a null id is the largest, and of repeated rows one
    stays. A null text equals the empty one. An empty table gives no rows. Texts
    never meet in a group: only (hash, text) pairs are aggregated, before and
    after the shuffle, and rows join their group's smallest id.
    """
    own = id_and_text(docs, id_col, text_col).select("doc_id", text_key(F.col("text")).alias("text_key"), normalised(F.col("text")).alias("text"))
    own = own.select("doc_id", "text_key", "text", hashed(F.col("text")).alias("content_hash"))

    def rows(texts: DataFrame, variant: Column) -> DataFrame:
        found = texts.select("doc_id", "text_key", "content_hash", variant.cast("int").alias("variant"), F.sha2("text", 256).alias("text_sha256"))
        return materialize(found.withColumn("uid", F.monotonically_increasing_id()), "digests")

    found = rows(own, F.lit(0))
    several = materialize(found.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("content_hash"), "several")
    texts = own.join(several, "content_hash", "left_semi").groupBy("content_hash", "text").agg(F.count(F.lit(1)).alias("n"))
    clashes = texts.groupBy("content_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("content_hash")
    if not clashes.isEmpty():
        # different texts under one hash: number them and begin again with the number in the key
        apart = texts.join(clashes, "content_hash", "left_semi").select(
            "content_hash", "text", F.row_number().over(Window.partitionBy("content_hash").orderBy("text")).alias("v"))
        found = rows(own.join(materialize(apart, "clashes"), ["content_hash", "text"], "left"), F.coalesce(F.col("v"), F.lit(0)))
    order = F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "uid")
    groups = found.groupBy("content_hash", "variant").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first")).where("n > 1")
    groups = materialize(groups, "groups")  # else the join shares the aggregate's partitions, and a large group can't be split
    joined = found.join(groups, ["content_hash", "variant"], "left")
    return joined.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce(F.col("n"), F.lit(1)).cast("long").alias("group_size"),
        (F.col("n").isNull() | (F.col("uid") == F.col("first.uid"))).alias("kept"),
        "text_sha256", "text_key",
    )


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return digests(docs, content_hash, id_col, text_col).drop("text_key")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they are."""
    return keep_marked(docs, digests(docs, content_hash, id_col, text_col), id_col, text_col)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


QUERIES = {"op9_exact_dedup": op9_exact_dedup}
SQL = {
    "op9_exact_dedup": r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents),
g as (select doc_id, t, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size from n)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from g"""
}
