"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.session import materialize

SUB_BATCH_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, a null text as the empty one: other columns can't clash."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch, column: str, limit: int = SUB_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of bounded text size; one longer text is a run of its own."""
    at, size = 0, 0
    for i, n in enumerate(pa.compute.binary_length(batch.column(column)).to_pylist()):
        if size and size + (n or 0) > limit:
            yield batch.slice(at, i - at)
            at, size = i, 0
        size += n or 0
    if at < batch.num_rows:
        yield batch.slice(at)


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def without(docs: DataFrame, bad: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``bad`` (doc_id, text_key) names; null ids match null ids.

    A verdict that depends on the text alone holds for every row of that id and
    text, so repeated rows go together and another text under the same id stays.
    """
    named = bad.select(bad["doc_id"].alias("bad_id"), bad["text_key"].alias("bad_key"))
    same = docs[id_col].cast("long").eqNullSafe(named["bad_id"]) & (text_key(docs[text_col]) == named["bad_key"])
    return docs.join(named, same, "left_anti")


def keep_marked(docs: DataFrame, marks: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``marks`` (doc_id, text_key, kept; one row for each of theirs) keeps.

    Rows are known by id and text. Of rows that repeat both, one stays if any is
    marked; null ids match null ids.
    """
    found = materialize(marks.select("doc_id", "text_key", "kept"), "marks")
    pairs = found.groupBy("doc_id", "text_key").agg(F.max("kept").alias("stays"), F.count(F.lit(1)).alias("n"))
    out = without(docs, pairs.where("n > 1 or not stays"), id_col, text_col)
    twice = pairs.where("n > 1 and stays")
    if twice.isEmpty():
        return out
    mark = "key_"
    while mark in docs.columns:
        mark += "_"
    named = twice.select(twice["doc_id"].alias("kept_id"), twice["text_key"].alias("kept_key"))
    again = docs.join(named, docs[id_col].cast("long").eqNullSafe(named["kept_id"]) & (text_key(docs[text_col]) == named["kept_key"]), "left_semi")
    return out.unionByName(again.withColumn(mark, text_key(F.col(text_col))).dropDuplicates([id_col, mark]).drop(mark))


def class_rank(df: DataFrame, cls: Sequence[str], salt: Column, order: Sequence[Column], name: str = "rank",
               keep: DataFrame | None = None) -> DataFrame:
    """Gapless rank from 0 within each class, without gathering a class in one task.

    Rows are numbered inside (class, salt); the counts of those give where each
    salt begins. The counts are summed before the shuffle and number classes x
    salts, so the window over them stays small however large a class is.
    """
    salted = df.withColumn("salt_", salt)
    counts = salted.groupBy(*cls, "salt_").agg(F.count(F.lit(1)).alias("n_"))
    before = Window.partitionBy(*cls).orderBy("salt_").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select(*cls, "salt_", F.coalesce(F.sum("n_").over(before), F.lit(0)).alias("begin_"))
    inner = F.row_number().over(Window.partitionBy(*cls, "salt_").orderBy(*order))
    return (
        salted.withColumn("in_", inner)
        .join(begins, [*cls, "salt_"])
        .withColumn(name, (F.col("begin_") + F.col("in_") - 1).cast("long"))
        .drop("salt_", "in_", "begin_")
    )
