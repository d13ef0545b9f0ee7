"""Shards by fixed virtual slots, with DataFrame functions only.

A row is hashed into one of a fixed number of virtual slots. Bytes are summed per slot, and a map from slots to shards
is made from the sums: slots in falling order of bytes, each to the shard with the fewest bytes so far. The map is a
small table with a version. Rebalancing edits it: a slot stays in its shard while that has room, so few rows move.

The law that holds is `bytes`: sizes near equal. Places within a shard come from counts per shard and slot added up,
and a row number within the slot, so no task sorts a shard.

Nulls and edges: a null text has 16 bytes and the CRC-32 of nothing. Null ids are hashed like others. Rows
that are equal in id, size and CRC-32 share a slot of the hash and get places in any order. An empty table gives no rows and a map
of empty slots. Only id and text are read, so other columns never clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablesync.session import settle

VIRTUAL = 8192
SHARDS = 40
OVERHEAD = 16
#: How far above the mean a shard may grow before a slot leaves it on rebalancing.
ROOM = 0.01


def sized(docs: DataFrame, id_col: str, text_col: str, virtual: int = VIRTUAL) -> DataFrame:
    """(doc_id, size, text_crc32, virtual) of every row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    return rows.withColumn("virtual", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(virtual)).cast("int"))


def slot_sums(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))


def assign(slots: Column, shards: int, room: float) -> Column:
    """For an array of slots (bytes, virtual, shard before or null) the map entries (virtual, shard), dealt in falling order of bytes.

    A fold keeps the bytes of every shard. Slots that have a shard come first and stay while it has room.
    """
    total = F.aggregate(slots, F.lit(0).cast("double"), lambda a, s: a + s["bytes"])
    limit = total / shards * (1 + room)
    start = F.struct(F.array_repeat(F.lit(0.0), shards).alias("loads"), F.array().cast("array<struct<virtual:int,shard:int>>").alias("map"), limit.alias("limit"))
    order = F.array_sort(F.transform(slots, lambda s: F.struct(s["shard"].isNull().alias("new"), (-s["bytes"]).alias("falling"), s["virtual"].alias("virtual"), s["shard"].alias("shard"))))

    def step(state: Column, slot: Column) -> Column:
        bytes_ = -slot["falling"]
        least = (F.array_position(state["loads"], F.array_min(state["loads"])) - 1).cast("int")
        stays = slot["shard"].isNotNull() & (slot["shard"] < shards) & (F.get(state["loads"], F.coalesce(slot["shard"], F.lit(0))) + bytes_ <= state["limit"])
        picked = F.array(F.when(stays, slot["shard"]).otherwise(least))
        return F.get(
            F.transform(
                picked,
                lambda shard: F.struct(
                    F.transform(state["loads"], lambda load, i: F.when(i == shard, load + bytes_).otherwise(load)).alias("loads"),
                    F.concat(state["map"], F.array(F.struct(slot["virtual"].alias("virtual"), shard.alias("shard")))).alias("map"),
                    state["limit"].alias("limit"),
                ),
            ),
            F.lit(0),
        )

    return F.aggregate(order, start, step, lambda s: s["map"])


def slot_map(spark: SparkSession, sums: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, before: DataFrame | None = None, room: float = ROOM) -> DataFrame:
    """(version, virtual, shard) for all virtual slots, as one table of the shared folder.

    `before` is an earlier map to edit: its version is raised by one and its slots move only where sizes ask for it.
    All of it is in one row of `virtual` entries, whatever the size of the data.
    """
    old = spark.range(virtual).select(F.col("id").cast("int").alias("virtual"), F.lit(None).cast("int").alias("shard"), F.lit(0).alias("version")) if before is None else before
    all_slots = old.join(sums, "virtual", "left").select("version", F.struct(F.coalesce("bytes", F.lit(0)).cast("double").alias("bytes"), "virtual", "shard").alias("slot"))
    gathered = all_slots.groupBy("version").agg(F.collect_list("slot").alias("slots"))
    entries = gathered.select((F.col("version") + 1).alias("version"), F.explode(assign(F.col("slots"), shards, room)).alias("e"))
    return settle(entries.select("version", "e.virtual", "e.shard"), "slot-map")


def place(docs: DataFrame, shards: int = SHARDS, virtual: int = VIRTUAL, id_col: str = "doc_id", text_col: str = "text", before: DataFrame | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot and map_version of every row."""
    rows = settle(sized(docs, id_col, text_col, virtual), "sized-rows")
    sums = settle(slot_sums(rows), "slot-sums")
    versioned = slot_map(docs.sparkSession, sums, shards, virtual, before)
    in_shard = Window.partitionBy("shard").orderBy("virtual").rowsBetween(Window.unboundedPreceding, -1)
    starts = versioned.join(sums, "virtual").withColumn("first", F.coalesce(F.sum("rows").over(in_shard), F.lit(0)))  # at most `virtual` rows
    in_slot = Window.partitionBy("virtual").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("place", F.row_number().over(in_slot))
    joined = numbered.join(F.broadcast(starts.select("virtual", "shard", "first", "version")), "virtual")
    return joined.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("virtual").alias("virtual_slot"),
        F.col("version").alias("map_version"),
    )
