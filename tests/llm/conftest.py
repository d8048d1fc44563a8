import pytest

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("uid", T.StringType()), T.StructField("text_key", T.StringType()), T.StructField("rank", T.IntegerType()),
])


@pytest.fixture
def table(spark):
    """Documents with columns whose names clash with those that operators add."""

    def make(rows):
        return spark.createDataFrame([(i, t, "xx", "u", "k", 7) for i, t in rows], SCHEMA)

    return make


@pytest.fixture
def odd_rows():
    """Null ids and texts, empty and long texts, repeated rows, one id with two texts."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(6000))
    return [(1, "Alpha beta gamma."), (1, "Alpha beta gamma."), (2, None), (3, ""), (None, "Alpha  beta\tgamma."), (None, None), (4, long), (5, long), (6, long + " end"),
            (7, "one\n two"), (7, "other text"), (8, "   "), (9, "Ünïcödé — 日本語 <|endoftext|> \x1c x"), (10, "a")]
