"""Sharding through fixed virtual slots and a versioned map from slots to shards.

A row's virtual slot is a hash and never changes. Bytes are summed by slot. The
map is a table of edits (version, virtual_slot, shard): version 0 places every
slot, each later version only the slots that a rebalancing moves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablewright.llm.common import class_rank, documents
from tablewright.session import materialize

SHARDS = 16
SLOTS = 4096
SALTS = 8  # parts in which a slot's rows are numbered


def slotted(docs: DataFrame, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1), text_crc32, virtual_slot of every row.

    The slot comes from id and text, so rows without an id spread as well.
    """
    text = F.coalesce(docs[text_col], F.lit(""))
    crc = F.crc32(text.cast("binary")).alias("text_crc32")
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), crc)
    return rows.withColumn("virtual_slot", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int"))


def slot_bytes(rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """(virtual_slot, bytes), one row for every slot; summed before the shuffle."""
    held = rows.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"))
    every = rows.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(held, "virtual_slot", "left").select("virtual_slot", F.coalesce("bytes", F.lit(0)).alias("bytes"))


def first_map(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Version 0: runs of slots of equal length."""
    return spark.range(slots).select(
        F.lit(0).alias("version"), F.col("id").cast("int").alias("virtual_slot"), F.expr(f"cast(id * {shards} div {slots} as int)").alias("shard"))


def current(slot_map: DataFrame) -> DataFrame:
    """(virtual_slot, shard) after all edits."""
    return slot_map.groupBy("virtual_slot").agg(F.max_by("shard", "version").alias("shard"))


def _over(slot_map: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """Slots with their bytes and whether they lie over an equal share of their shard, the largest counted first."""
    placed = current(slot_map).join(weights, "virtual_slot")
    down = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "virtual_slot").rowsBetween(Window.unboundedPreceding, 0)
    total = Window.partitionBy()  # one row per slot, a fixed number
    return placed.select("virtual_slot", "shard", "bytes",
                         ((F.sum("bytes").over(down) * shards > F.sum("bytes").over(total)) & (F.col("bytes") > 0)).alias("over"))


def rebalance(slot_map: DataFrame, weights: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The edits of the next version: slots over their shard's share go, largest first, to the lightest shard."""
    rows = _over(slot_map, weights, shards)
    loads = rows.groupBy("shard").agg(F.sum(F.when(~F.col("over"), F.col("bytes")).otherwise(0)).alias("load"))
    state = loads.agg(F.map_from_entries(F.collect_list(F.struct("shard", "load"))).alias("by_shard")).select(
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.coalesce(F.col("by_shard")[s], F.lit(0).cast("long"))).alias("loads"))
    moved = rows.where("over").agg(
        F.reverse(F.array_sort(F.collect_list(F.struct("bytes", "virtual_slot")))).alias("moved"))
    version = slot_map.agg((F.max("version") + 1).alias("version"))

    def place(acc, x):
        light = (F.array_position(acc["loads"], F.array_min(acc["loads"])) - 1).cast("int")
        return F.struct(
            F.transform(acc["loads"], lambda load, i: F.when(i == light, load + x["bytes"]).otherwise(load)).alias("loads"),
            F.concat(acc["edits"], F.array(F.struct(x["virtual_slot"].alias("virtual_slot"), light.alias("shard")))).alias("edits"))

    none = F.array().cast("array<struct<virtual_slot:int,shard:int>>")
    folded = F.aggregate("moved", F.struct(F.col("loads"), none.alias("edits")), place, lambda acc: acc["edits"])
    # three tables of one row each
    one = state.crossJoin(F.broadcast(moved)).crossJoin(F.broadcast(version))
    return one.select("version", F.explode(folded).alias("e")).select("version", "e.virtual_slot", "e.shard")


def add_shard(slot_map: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The edits that open shard ``shards``: each shard gives what lies over its new share, nothing else moves."""
    version = slot_map.agg((F.max("version") + 1).alias("version"))
    taken = _over(slot_map, weights, shards + 1).where("over")
    return taken.crossJoin(F.broadcast(version)).select("version", "virtual_slot", F.lit(shards).cast("int").alias("shard"))


def shard_rows(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, id_col: str = "doc_id", text_col: str = "text",
               slot_map: DataFrame | None = None) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot (its place there, gapless from 0), virtual_slot, map_version.

    Law ``bytes``: shards hold nearly equal sizes. Null text: size 1, checksum 0.
    Null ids and repeated rows are rows like any other; rows equal in id and text
    share a virtual slot, which is the smallest unit that moves. An empty table
    gives no rows. The text is read once; only ids, sizes and checksums move.
    """
    spark = docs.sparkSession
    rows = materialize(slotted(docs, slots, id_col, text_col).withColumn("uid", F.monotonically_increasing_id()), "slotted")
    weights = materialize(slot_bytes(rows, slots), "slot-bytes")
    before = first_map(spark, shards, slots) if slot_map is None else slot_map
    edits = materialize(before.unionByName(rebalance(before, weights, shards)), "slot-map")
    placed = rows.join(F.broadcast(current(edits)), "virtual_slot")  # ``slots`` rows
    salt = F.col("virtual_slot") * SALTS + F.pmod(F.col("uid"), F.lit(SALTS))
    ranked = class_rank(placed, ["shard"], salt, [F.col("doc_id"), F.col("uid")], "slot")
    version = edits.agg(F.max("version").alias("map_version"))
    return ranked.crossJoin(F.broadcast(version)).select("doc_id", "size", "text_crc32", "shard", "slot", "virtual_slot", "map_version")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot", "map_version")


QUERIES = {"op1_sharding": op1_sharding}
