"""Queries on rows that the sample tables don't have."""

import pytest
from pyspark.sql import functions as F

from tablewright.catalog import all_queries
from tablewright.catalog.prepare import _word_rows
from tablewright.catalog.profile import term_rows
from tablewright.session import spread
from tablewright.sources.matrix import add_duplicates


@pytest.fixture(scope="module")
def odd_documents(spark, tmp_path_factory):
    """Texts without a word, no text, no language, and a language of its own."""
    sf = str(tmp_path_factory.mktemp("odd"))
    words = {"de": "der die das drei", "en": "an apple a day", "es": "el es en esta", "fr": "la le les leur", "it": "il io in un"}
    rows = [(i, lang, f"{w} {w.split()[i % 4]}") for i, (lang, w) in enumerate(list(words.items()) * 40)]
    rows += [(1000, "en", ""), (1001, "fr", "12 !"), (1002, "de", None), (1003, None, "no language")]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").withColumn("n_chars", F.length("text").cast("bigint"))
    df.write.parquet(f"{sf}/documents.parquet")
    return sf


def test_texts_without_words_are_zero_rows(spark, odd_documents):
    got = {r["doc_id"]: (r["indices"], r["values"]) for r in term_rows(spark, odd_documents).where("doc_id >= 1000").collect()}
    assert got == {1000: ([], []), 1001: ([], []), 1002: ([], []), 1003: ([11, 13], [1.0, 1.0])}
    words = _word_rows(spark, odd_documents).where("lang is null or size(indices) = 0").collect()
    assert sorted((r["indices"], r["values"]) for r in words) == [([], [])] * 3 + [(["language", "no"], [1.0, 1.0])]


def test_no_pairs_have_no_sums(spark):
    none = spark.range(1).select(F.array().cast("array<struct<idx:int,val:double>>").alias("p"))
    assert none.select(add_duplicates(F.col("p")).alias("s")).first()["s"] == []


@pytest.mark.parametrize("name", ["g06_multinomial_bayes", "g01_linear_svc_sparse"])
def test_sparse_models_take_wordless_unlabelled_and_other_languages(spark, odd_documents, name):
    scores = [r["score"] for r in all_queries()[name](spark, odd_documents).collect()]
    assert len(scores) >= 9 and all(s > 0.85 for s in scores)


def test_shares_of_a_table_that_just_fills_the_cores_are_small(spark):
    cores = spark.sparkContext.defaultParallelism
    parts = [spread(spark.range(0, 1000, 1, n)).rdd.getNumPartitions() for n in (1, cores, 2 * cores - 1, 2 * cores, 5 * cores)]
    assert parts == [cores, 8 * cores, 8 * cores, 2 * cores, 5 * cores]
