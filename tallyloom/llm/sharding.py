"""Sharding by fixed virtual slots and a versioned map from slots to shards.

Every record is hashed into one of SLOTS slots, for good. What changes is the map from
slots to shards: version 0 deals the slots round, and each edit makes the next version
from the bytes that the slots hold. An edit lets every shard keep its largest slots up to
the mean and deals what is over, largest first, to the shard with the least. So most slots
stay where they are, and shards that are added or given up take part in the same way.

Records shuffle as narrow rows; only sums per slot, at most SLOTS rows, reach the edit,
which is one aggregate over a sorted array. Positions in a shard are the rows of its earlier
slots plus the place in the own slot, so no task ever sorts a shard.

Defined results: a null text has no bytes and the checksum of the empty text, every record
counts one byte more; a null id is hashed as the text "null"; records are dealt by id and
checksum, so different texts under one id spread, and so do the copies of one record; a text is never split, so one that is larger than the mean
makes its shard larger too; an empty table gives an empty result and a map of empty slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import let
from tallyloom.sources.stage import stage, stage_path

SLOTS = 8192
SHARDS = 16


def record_slots(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, vslot, copies, part): one row per different record, or several of a repeated one."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("n"))
    # copies of one record go to different slots, so that a record in a third of all rows spreads too
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.col("n"), F.lit(slots)) - 1)).alias("part")
    parts = counted.select("*", part).withColumn("copies", F.ceil((F.col("n") - F.col("part")) / slots))
    named = F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text_crc32").cast("string"),
        F.when(F.col("part") > 0, F.col("part").cast("string")),
    )
    vslot = F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long") % slots
    return parts.select("doc_id", "size", "text_crc32", vslot.alias("vslot"), "copies", "part")


def slot_loads(records: DataFrame) -> DataFrame:
    """(vslot, bytes, rows) of the slots that hold records."""
    return records.groupBy("vslot").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("rows"))


def first_map(spark: SparkSession, slots: int = SLOTS, shards: int = SHARDS) -> DataFrame:
    """Version 0: (vslot, shard), slots dealt round."""
    return spark.range(slots).select(F.col("id").alias("vslot"), (F.col("id") % shards).cast("int").alias("shard"))


def save_map(slot_map: DataFrame, folder: str, version: int) -> None:
    """Store a version beside the earlier ones. A version is never written twice."""
    slot_map.select("vslot", "shard").coalesce(1).write.parquet(f"{folder}/version={version}")


def load_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """(vslot, shard, version) of the given version, or else of the latest one."""
    stored = spark.read.schema("vslot long, shard int, version int").parquet(folder)
    if version is not None:
        return stored.where(F.col("version") == version)
    latest = stored.agg(F.max("version").alias("version"))
    return stored.join(F.broadcast(latest), "version", "left_semi")


def _least(loads: Column, body) -> Column:
    """body(index) of the first shard with the least load, 0-based."""
    return let(F.array_position(loads, F.array_min(loads)).cast("int") - 1, body)


def _deal(state: Column, freed: Column) -> Column:
    """Give one slot to the shard with the least bytes."""
    return _least(
        state["loads"],
        lambda i: F.struct(
            F.transform(state["loads"], lambda x, k: F.when(k == i, x + freed["bytes"]).otherwise(x)).alias("loads"),
            F.array_append(state["picks"], F.struct(freed["vslot"].alias("vslot"), i.alias("shard"))).alias("picks"),
        ),
    )


def edited_map(slot_map: DataFrame, loads: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version for `shards` shards: (vslot, shard), near equal in bytes.

    The tables have one row per slot, which is what bounds the windows and the array here.
    """
    known = slot_map.select("vslot", "shard").join(loads.select("vslot", "bytes"), "vslot", "left").na.fill(0, ["bytes"])
    mean = F.ceil(F.sum("bytes").over(Window.partitionBy()) / F.lit(shards))
    largest = Window.partitionBy("shard").orderBy(F.col("bytes").desc(), "vslot")
    upto = F.sum("bytes").over(largest.rowsBetween(Window.unboundedPreceding, 0))
    fits = (upto <= mean) | (F.row_number().over(largest) == 1) | (F.col("bytes") == 0)
    judged = stage(known.withColumn("keep", fits & (F.col("shard") < shards)))
    kept = judged.where("keep").groupBy("shard").agg(F.sum("bytes").alias("bytes"))
    every = judged.sparkSession.range(shards).select(F.col("id").cast("int").alias("shard"))
    start = every.join(kept, "shard", "left").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("shard", F.coalesce("bytes", F.lit(0)).alias("bytes")))), lambda s: s["bytes"]).alias("loads")
    )
    over = judged.where("not keep").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "vslot"))),
            lambda s: F.struct((-s["less"]).alias("bytes"), s["vslot"].alias("vslot")),
        ).alias("freed")
    )
    none = F.array().cast("array<struct<vslot:bigint,shard:int>>")
    dealt = F.aggregate("freed", F.struct(F.col("loads"), none.alias("picks")), _deal, lambda s: s["picks"])
    moved = over.withColumn("loads", start.scalar()).select(F.inline(dealt))
    return judged.where("keep").select("vslot", "shard").unionByName(moved)


def placed(records: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with shard and slot, their place in the shard, counted from 0."""
    held = slot_loads(records).join(slot_map, "vslot")
    earlier = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("vslot", "shard", "version", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("vslot").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "part")
    upto = F.sum("copies").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    rows = records.withColumn("upto", upto)
    # one row per slot, SLOTS at most
    rows = rows.join(F.broadcast(starts), "vslot")
    first = F.col("start") + F.col("upto") - F.col("copies")
    return rows.withColumn("slot", F.explode(F.sequence(first, first + F.col("copies") - 1))).drop("upto", "copies", "start", "part")


def shard_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None
) -> DataFrame:
    """One row per row of docs: doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, map_version.

    `folder` holds the versions of a map; without one, version 0 is stored in a folder of
    its own. Every call edits the latest version for the bytes of these documents and stores
    the result as the next one.
    """
    spark = docs.sparkSession
    records = stage(record_slots(docs, id_col, text_col, slots))
    if folder is None:
        folder = stage_path(spark, "slot-map")
        save_map(first_map(spark, slots, shards), folder, 0)
    now = load_map(spark, folder)
    version = now.agg(F.max("version")).first()[0]
    save_map(edited_map(now, slot_loads(records), shards), folder, version + 1)
    return placed(records, load_map(spark, folder, version + 1)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.col("version").alias("map_version"),
    )
