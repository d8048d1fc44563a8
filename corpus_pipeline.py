"""Corpus cleaning from documents to packed sequences; each stage calls one operator of ``tablewright.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tablewright.llm import decontaminate, exact_dedup, near_dup, toxicity as civil
from tablewright.llm.common import documents
from tablewright.llm.packing import pack_documents
from tablewright.llm.tokens import public_path
from tablewright.session import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score toxic go; the model learns from those of ``docs`` that carry labels."""
    model = civil.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return civil.keep_civil(docs, model)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of texts with similar word n-grams stays."""
    return near_dup.keep_one(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into token sequences."""
    return pack_documents(docs, public_path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("best_fit_packing", packing),
]

#: Tokens, hashes and learned scores have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
