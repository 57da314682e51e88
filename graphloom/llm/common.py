"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and U+0009..U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: A key with more than this part of a join's rows is hot: its rows are dealt over several tasks.
HOT_PARTS = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, ``spark.checkpoint.dir``.

    Where it is unset, a temporary folder serves in local mode, where all are one process; anywhere else this is an error.
    """
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.graphloom.local.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="graphloom-")
        spark.conf.set("spark.graphloom.local.dir", path)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, whose files go when the driver's JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(conf).deleteOnExit(target)
    return path


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage, survives a lost executor, and gives Catalyst the real
    size, so that joins are broadcast only below the session's threshold.
    """
    path = scratch(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def carried(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct, so that no name of theirs meets one of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(docs: DataFrame, row: str = "row") -> list[Column]:
    """The columns of ``docs`` out of that struct."""
    return [F.col(f"{row}.`{c}`").alias(c) for c in docs.columns]


def spread_join(rows: DataFrame, keys: DataFrame, on: list[str], n: str = "n") -> DataFrame:
    """Inner join of rows with ``keys``, which has one row a key and in ``n`` how many rows have it; no key fills a task.

    A key of more than 1 in HOT_PARTS of all rows is dealt by a hash of the row over as many parts as it
    is times too large, and its row of ``keys`` goes to each. There are fewer than HOT_PARTS
    such keys whatever the input, so their list is broadcast. ``keys`` is read twice: pass a written table.
    """
    total = keys.agg(F.sum(n)).first()[0] or 0
    most = F.lit(max(1, total // HOT_PARTS))
    hot = keys.where(F.col(n) > most).select(*on, F.ceil(F.col(n) / most).alias("_parts"))
    part = F.when(F.col("_parts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*rows.columns), F.col("_parts"))).cast("int")
    dealt = rows.join(F.broadcast(hot), on, "left").withColumn("_part", part).drop("_parts")
    every = F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.col(n) / most), F.lit(1)).cast("int") - 1))
    return dealt.join(keys.withColumn("_part", every).hint("merge"), [*on, "_part"]).drop("_part")


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
