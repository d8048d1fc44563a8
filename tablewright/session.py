"""Session helpers: tuned defaults and the shared scratch folder."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "tablewright") -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    n = 8 if cores == "*" else int(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


_local_scratch: list[str] = []


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session that names none (tests, laptops) gets a folder of this
    machine; on a cluster its executors could not see it, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _local_scratch:
            _local_scratch.append(tempfile.mkdtemp(prefix="tablewright-"))
        named = _local_scratch[0]
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path below the shared folder."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a table that outlives any executor.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BUSY_TASKS = 8  # shares of a core in a table that fills the cores already


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a small input; a large scan already has enough splits.

    In between, where a scan gives every core a split but hardly more, shares are
    as small as those of a table several times as large.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    n = df.rdd.getNumPartitions()
    return df if n >= 2 * cores else df.repartition(cores if n < cores else BUSY_TASKS * cores)


def small_table(spark: SparkSession, columns: dict[str, Sequence], types: dict[str, pa.DataType]) -> DataFrame:
    """A table of driver-side values; Arrow keeps it a JVM-local relation."""
    arrays = [pa.array(list(columns[c]), types[c]) for c in types]
    return spark.createDataFrame(pa.table(arrays, names=list(types)))


def pinned(df: DataFrame) -> DataFrame:
    """Compute a small result once and keep its rows as a local relation.

    For tables whose size is bounded by classes, folds or features only.
    """
    return df.sparkSession.createDataFrame(df.toArrow())


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_tablewright_shipped", False):
        return
    root = Path(__file__).resolve().parent
    files = sorted(root.rglob("*.py"))
    digest = hashlib.md5(b"".join(f.read_bytes() for f in files)).hexdigest()[:12]
    archive = Path(tempfile.mkdtemp(prefix="tablewright-")) / f"tablewright-{digest}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in files:
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(archive))
    sc._tablewright_shipped = True


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with this package available to the workers."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
