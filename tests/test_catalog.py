"""Every query with an SQL twin gives the twin's rows."""

import glob
import math
import os

import duckdb
import pytest

from samples import SF
from tablewright.catalog import all_queries, all_sql

SLOW = ("h03", "h07", "h08", "h11", "h12")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def plain(v):
    if v is None or str(v) == "<NA>" or (isinstance(v, float) and math.isnan(v)):
        return None
    v = v.item() if hasattr(v, "item") else v
    return round(v, 6) if isinstance(v, float) else v


def rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    out = [tuple(plain(v) for v in r) for r in pdf.itertuples(index=False)]
    return sorted(out, key=lambda r: tuple((v is None, type(v).__name__, v if v is not None else 0) for v in r))


def test_names():
    assert set(all_sql()) <= set(all_queries())


@pytest.mark.parametrize("name", sorted(all_sql()))
def test_query_equals_sql(spark, duck, name):
    got = all_queries()[name](spark, SF).toPandas()
    want = duck.execute(all_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
