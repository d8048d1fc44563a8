"""A fitted predictor works row by row, so it also scores a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tablewright.plans.predictor import TablePredictor


def score_stream(predictor: TablePredictor, stream: DataFrame, keys: Sequence[str], sink: str,
                 checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append predictions as Parquet; the checkpoint folder makes restarts exact."""
    out = predictor.predict(stream, keys).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if once:
        out = out.trigger(availableNow=True)
    return out.outputMode("append").start(sink)
