"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tablewright.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a long, b long): root is the smallest node it is connected with.

    Each round joins nodes with the smallest of their neighbours, first for the
    larger neighbours, then for the smaller ones; the number of rounds grows
    with the logarithm of the longest path. Rounds are written to the shared
    folder. Links never leave the executors; minima are taken before the shuffle.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # minima are written: a join that shares the aggregate's partitions couldn't split a node with many links
        low = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m")), "low")
        large = both.join(low, both["a"] == low["n"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = materialize(large.where("a <> b").distinct(), "large")
        least = materialize(large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m"), "least")
        small = large.join(least, large["a"] == least["n"]).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(small.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
