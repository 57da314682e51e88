"""Sharding over fixed virtual slots.

A record's key is hashed into one of ``SLOTS`` slots, and a small versioned map, stored as
a table, says which shard owns each slot. The first map gives a slot to the shard of the
highest hash (slot, shard); one more shard then takes slots only into itself.
Bytes are added up per slot, and ``rebalance`` edits the map by them: it moves
slots from overfull to underfull shards and writes only the next version.

Defined results: a null doc_id is a key like any other; a null text has no bytes
and size 1; equal rows get slots of their own, in any order among them; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch, stage, utf8_bytes

SLOTS = 4096
#: A slot's rows are numbered in this many parts, so a slot that one key fills is no single task's work.
PARTS = 16


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def initial_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """(version, vslot, shard): ``slots`` rows; depends on the shard count alone."""
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: F.struct(F.xxhash64(F.col("vslot"), s).alias("h"), s.alias("shard"))))
    return spark.range(slots).select(F.lit(1).alias("version"), F.col("id").cast("int").alias("vslot")).withColumn("shard", best["shard"].cast("int"))


def grow_map(current: DataFrame, shard: int) -> DataFrame:
    """The next version, with one more shard numbered ``shard``: slots move only into it."""
    here = F.xxhash64(F.col("vslot"), F.col("shard"))
    new = F.xxhash64(F.col("vslot"), F.lit(shard))
    return current.select((F.col("version") + 1).alias("version"), "vslot", F.when(new > here, F.lit(shard)).otherwise(F.col("shard")).cast("int").alias("shard"))


def slot_bytes(rows: DataFrame) -> DataFrame:
    """(vslot, rows, bytes), a row a slot at most, of rows (vslot, m, size): m records of so many bytes each."""
    return rows.groupBy("vslot").agg(F.sum("m").alias("rows"), F.sum(F.col("m") * F.col("size")).alias("bytes"))


def rebalance(current: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version of a map, edited so that each shard's bytes come near the mean.

    Slots leave a shard, the smallest first, while what stays is above the mean; the
    moved slots are laid end to end along the shards' free room. Works on at most
    ``SLOTS`` rows, whatever the number of documents.
    """
    m = current.join(weights, "vslot", "left").withColumn("bytes", F.coalesce("bytes", F.lit(0)))
    mean = (m.agg(F.sum("bytes")).first()[0] or 0) / shards
    largest_first = Window.partitionBy("shard").orderBy(F.desc("bytes"), "vslot")
    m = m.withColumn("run", F.sum("bytes").over(largest_first.rowsBetween(Window.unboundedPreceding, 0)))
    m = m.withColumn("moves", (F.col("run") > mean) & (F.row_number().over(largest_first) > 1) & (F.col("bytes") > 0))
    every = current.sparkSession.range(shards).select(F.col("id").cast("int").alias("to_shard"))
    stays = m.groupBy(F.col("shard").alias("to_shard")).agg(F.sum(F.when(~F.col("moves"), F.col("bytes")).otherwise(0)).alias("kept"))
    room = every.join(stays, "to_shard", "left").withColumn("room", F.greatest(F.lit(mean) - F.coalesce("kept", F.lit(0)), F.lit(0.0)))
    room = room.withColumn("hi", F.sum("room").over(Window.orderBy("to_shard").rowsBetween(Window.unboundedPreceding, 0)))
    room = room.withColumn("lo", F.col("hi") - F.col("room")).where("room > 0")
    free = room.agg(F.max("hi")).first()[0] or 0.0
    along = Window.orderBy(F.desc("bytes"), "vslot").rowsBetween(Window.unboundedPreceding, 0)
    moved = m.where("moves").withColumn("at", F.least(F.sum("bytes").over(along) - F.col("bytes") / 2, F.lit(free * (1 - 1e-9))))
    placed = moved.join(F.broadcast(room), (F.col("at") >= F.col("lo")) & (F.col("at") < F.col("hi"))).select("vslot", "to_shard")
    return current.join(placed, "vslot", "left").select(
        (F.col("version") + 1).alias("version"), "vslot", F.coalesce("to_shard", "shard").cast("int").alias("shard")
    )


def save_map(current: DataFrame, path: str) -> None:
    """Append this version of the map to the table at ``path``."""
    current.coalesce(1).write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given version of a stored map, or the latest."""
    maps = spark.read.parquet(path)
    version = version if version is not None else maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).select("version", "vslot", "shard")


def store_maps(spark: SparkSession, path: str, weights: DataFrame, shards: int, slots: int = SLOTS) -> None:
    """Stores three versions of the map: the first, the one with one more shard, and that one rebalanced by bytes."""
    save_map(initial_map(spark, shards, slots), path)
    save_map(grow_map(load_map(spark, path, 1), shards), path)
    save_map(rebalance(load_map(spark, path, 2), weights, shards + 1), path)


def edit_maps(spark: SparkSession, path: str, weights: DataFrame, shards: int, slots: int) -> int:
    """Stores a map and its next two versions, or, where one is stored already, the next two versions after its last; gives the number of the first of the three."""
    if not stored(spark, path):
        store_maps(spark, path, weights, shards, slots)
        return 1
    last = load_map(spark, path)
    version, owned = last.agg(F.max("version"), F.max("shard") + 1).first()
    save_map(grow_map(last, owned), path)
    save_map(rebalance(load_map(spark, path, version + 1), weights, owned + 1), path)
    return version


def stored(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def assign_shards(docs: DataFrame, shards: int = 16, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, vslot, slot_bytes, balanced_shard for each row of ``docs``.

    Shards are read from the stored map: ``shard`` from its first version, ``grown_shard`` from the second, which has one more, and
    ``balanced_shard`` from the third, in which slots have moved by their bytes. ``slot`` numbers a shard's rows from 0 without gaps: the
    shard's virtual slots in order, each in ``PARTS`` parts. Both counts and numbers come from rows that are
    added up by content first, and the table of offsets has at most
    ``slots * PARTS`` rows, which is what is broadcast. ``path`` is where the map is kept (a scratch folder if none is given); one
    that is there already is edited: its last version is rebalanced by these documents' bytes, and its shards are those of that version.
    """
    spark = docs.sparkSession
    rows = docs.select(
        "doc_id", (utf8_bytes(F.col("text")) + 1).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32")
    ).withColumn("vslot", slot_of(F.col("doc_id"), slots))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("text_crc32", "size"), F.lit(PARTS)).cast("int"))
    units = stage(rows.groupBy("vslot", "part", "doc_id", "size", "text_crc32").agg(F.count("*").alias("m")))
    path = path or scratch(spark, "slot-map")
    weights = stage(slot_bytes(units))
    first = edit_maps(spark, path, weights, shards, slots)
    owners = load_map(spark, path, first).select("vslot", "shard")
    for version, name in ((first + 1, "grown_shard"), (first + 2, "balanced_shard")):
        owners = owners.join(F.broadcast(load_map(spark, path, version).select("vslot", F.col("shard").alias(name))), "vslot")
    owners = owners.join(F.broadcast(weights.select("vslot", F.col("bytes").alias("slot_bytes"))), "vslot")
    counts = units.groupBy("vslot", "part").agg(F.sum("m").alias("rows"))
    ahead = Window.partitionBy("shard").orderBy("vslot", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.join(F.broadcast(owners), "vslot").withColumn("offset", F.coalesce(F.sum("rows").over(ahead), F.lit(0))).drop("rows")
    inside = Window.partitionBy("vslot", "part").orderBy(F.col("doc_id").asc_nulls_last(), "size", "text_crc32")
    placed = units.withColumn("upto", F.sum("m").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.join(F.broadcast(offsets), ["vslot", "part"])
    placed = placed.withColumn("j", F.explode(F.sequence(F.col("upto") - F.col("m"), F.col("upto") - 1)))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("offset") + F.col("j")).cast("long").alias("slot"), "grown_shard", "vslot",
        "slot_bytes", "balanced_shard",
    )
