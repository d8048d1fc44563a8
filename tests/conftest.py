import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from samples import SF  # noqa: E402
from tablewright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "tests")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def lineitem(spark):
    from pyspark.sql import functions as F

    return spark.read.parquet(f"{SF}/lineitem.parquet").withColumn(
        "cents", F.round(F.col("l_extendedprice") * 100).cast("bigint")
    )

