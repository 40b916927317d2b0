"""Sharding by fixed virtual slots.

Records are hashed to a fixed number of slots, thousands whatever the data. A
stored, versioned map gives each slot a shard. The first map spreads the slots'
bytes evenly; rebalancing edits the map and moves few slots. Only tables with a
row per slot, so of fixed size, are ever sorted, gathered or broadcast.

Defined results: a NULL text has no bytes and the check sum of an empty text. A
record without an id is placed by its text. Repeated rows share a slot and are
all kept, and of ties in all that orders a slot any may come first. A text of any length
is one record. An empty table gives no rows, with a map of empty slots. Columns of the input
named like a computed one stay under another name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from plateward.llm.common import let, total, with_columns
from plateward.session import scratch_path, stored

SLOTS = 4096
ROW_BYTES = 8
MAP_COLUMNS = ("version", "virtual_slot", "shard")


def record_bytes(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint")


def virtual_slot(record_id: Column, text: Column, slots: int = SLOTS) -> Column:
    """The slot of a record: a hash of its id, or of its text where it has none."""
    key = F.when(record_id.isNull(), F.xxhash64(F.lit(1), text)).otherwise(F.xxhash64(F.lit(0), record_id))
    return F.pmod(key, F.lit(slots)).cast("int")


def slot_sizes(spark: SparkSession, records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Bytes and rows of every slot, the empty ones too. ``records`` has ``virtual_slot`` and ``size``."""
    sums = records.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    every = spark.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(F.broadcast(sums), "virtual_slot", "left").na.fill(0, ["bytes", "rows"])


def _placed(waiting: DataFrame, loads: Column) -> DataFrame:
    """Slots given out from the largest down, each to the shard with the least bytes so far.

    ``waiting`` is one row with an array ``slots`` of (bytes, slot), largest
    first; ``loads`` the bytes that each shard has already.
    """
    start = F.struct(
        loads.alias("loads"), F.array().cast("array<int>").alias("shards")
    )

    def step(state: Column, slot: Column) -> Column:
        def give(least: Column) -> Column:
            after = F.transform(
                state["loads"], lambda b, k: F.when(k == least, b + slot["bytes"]).otherwise(b)
            )
            return F.struct(
                after.alias("loads"), F.concat(state["shards"], F.array(least)).alias("shards")
            )

        position = F.array_position(state["loads"], F.array_min(state["loads"])) - 1
        return let(position.cast("int"), give)

    chosen = F.aggregate("slots", start, step, lambda state: state["shards"])
    return waiting.select("slots", chosen.alias("shards")).select(
        F.explode(F.arrays_zip("slots", "shards")).alias("z")
    ).select(F.col("z.slots.virtual_slot").alias("virtual_slot"), F.col("z.shards").alias("shard"))


def _largest_first(sizes: DataFrame) -> DataFrame:
    """One row: every slot of a table of fixed size, from the largest down."""
    order = F.struct((-F.col("bytes")).alias("key"), "virtual_slot", "bytes")
    return sizes.agg(F.sort_array(F.collect_list(order)).alias("slots"))


def first_map(sizes: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map, for slots of the given sizes."""
    empty = F.array_repeat(F.lit(0).cast("bigint"), shards)
    placed = _placed(_largest_first(sizes), empty)
    return placed.select(F.lit(1).cast("bigint").alias("version"), "virtual_slot", "shard")


def rebalanced(current: DataFrame, sizes: DataFrame, shards: int, tolerance: float = 0.02) -> DataFrame:
    """The map's next version, for new sizes or another number of shards.

    A shard keeps its slots, largest first, as long as they stay within
    ``tolerance`` of the mean; only the rest, and the slots of shards that are
    gone, move. So one more shard receives slots and no others exchange any.
    """
    held = sizes.join(F.broadcast(current), "virtual_slot")
    by_size = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    mean = F.sum("bytes").over(Window.partitionBy()) / shards
    marked = held.withColumns(
        {"so_far": F.sum("bytes").over(by_size), "room": mean * (1 + tolerance)}
    ).withColumn("stays", (F.col("so_far") <= F.col("room")) & (F.col("shard") < shards))
    order = F.struct((-F.col("bytes")).alias("key"), "virtual_slot", "bytes")
    lists = marked.agg(
        F.sort_array(F.collect_list(F.when(~F.col("stays"), order))).alias("slots"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("held"),
    )
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda s: total(
            F.transform(F.filter("held", lambda h: h["shard"] == s), lambda h: h["bytes"])
        ),
    )
    moved = _placed(lists, loads)
    version = current.agg(F.max("version")).first()[0] + 1
    slots = marked.where("stays").select("virtual_slot", "shard").unionByName(moved)
    return slots.select(F.lit(version).cast("bigint").alias("version"), "virtual_slot", "shard")


def keep_map(new: DataFrame, folder: str) -> DataFrame:
    """Append a version to the stored map and return that version as stored."""
    version = new.agg(F.max("version")).first()[0]
    new.write.mode("append").parquet(folder)
    return map_version(new.sparkSession, folder, version)


def map_version(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """One version of a stored map; the last if none is named."""
    kept = spark.read.schema("version bigint, virtual_slot int, shard int").parquet(folder)
    if version is None:
        version = kept.agg(F.max("version")).first()[0]
    return kept.where(F.col("version") == version)


def placed(records: DataFrame, slot_map: DataFrame, sizes: DataFrame, tie: list[str]) -> DataFrame:
    """Records with their shard and ``slot``, their place in the shard, from 0 without gaps.

    A place is the rows of the shard's earlier virtual slots, from the table of
    slots, plus the place among the rows of the own one: no window ever holds a
    whole shard. ``tie`` orders the rows of a virtual slot.
    """
    earlier = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.join(F.broadcast(sizes), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("__rows_before")
    )
    inside = F.row_number().over(Window.partitionBy("virtual_slot").orderBy(*tie)) - 1
    ranked = records.withColumn("__place", inside)
    return (
        ranked.join(F.broadcast(offsets), "virtual_slot")
        .withColumn("slot", F.col("__rows_before") + F.col("__place"))
        .drop("__rows_before", "__place")
    )


def _other_names(columns: list[str], computed: set[str]) -> dict[str, str]:
    """New names for columns that clash, none of them taken."""
    names, taken = {}, {c.lower() for c in columns} | computed
    for c in columns:
        if c.lower() in computed:
            other = f"given_{c}"
            while other.lower() in taken:
                other = f"given_{other}"
            names[c] = other
            taken.add(other.lower())
    return names


def sharded(
    docs: DataFrame,
    shards: int,
    slot_map: DataFrame | None = None,
    slots: int = SLOTS,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``virtual_slot``, ``map_version``, ``shard`` and ``slot``.

    A column of the documents with one of these names, in any case, stays under ``given_<name>``.

    ``slot_map`` is a version of a stored map, used as it is. Without one the
    first version is computed for these records and stored.
    """
    spark = docs.sparkSession
    text = F.col(f"`{text_column}`")
    computed = {"size", "text_crc32", "virtual_slot", "map_version", "shard", "slot"}
    records = with_columns(
        docs.withColumnsRenamed(_other_names(docs.columns, computed)),
        {
            "size": record_bytes(text),
            "text_crc32": F.crc32(F.coalesce(text, F.lit("")).cast("binary")),
            "virtual_slot": virtual_slot(F.col(f"`{id_column}`"), text, slots),
        },
    )
    sizes = stored(slot_sizes(spark, records.select("virtual_slot", "size"), slots), "slot-sizes")
    if slot_map is None:
        slot_map = keep_map(first_map(sizes, shards), scratch_path(spark, "slot-map"))
    version = slot_map.agg(F.max("version")).first()[0]
    rows = placed(records, slot_map.drop("version"), sizes, [f"`{id_column}`", "text_crc32", "size"])
    return rows.withColumn("map_version", F.lit(version).cast("bigint"))


def grown(
    docs: DataFrame, shards: int, slots: int = SLOTS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Per record: its id, ``virtual_slot``, ``size``, ``shard`` by the first map and ``next_shard`` by the map's edit
    for one shard more.

    Both versions are stored in one folder.
    """
    spark, text = docs.sparkSession, F.col(f"`{text_column}`")
    records = docs.select(
        F.col(f"`{id_column}`").alias(id_column),
        record_bytes(text).alias("size"),
        virtual_slot(F.col(f"`{id_column}`"), text, slots).alias("virtual_slot"),
    )
    sizes = stored(slot_sizes(spark, records, slots), "slot-sizes")
    folder = scratch_path(spark, "slot-map")
    first = keep_map(first_map(sizes, shards), folder)
    second = keep_map(rebalanced(first, sizes, shards + 1), folder)
    both = first.drop("version").join(
        second.select("virtual_slot", F.col("shard").alias("next_shard")), "virtual_slot"
    )
    # A row per virtual slot.
    return records.join(F.broadcast(both), "virtual_slot")
