"""Cutting a plan where its rows are used more than once."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where it is unset, a temporary one in local mode, where all are one process, and else an error."""
    path = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.graphloom.local.dir", None)
    if not path:
        if spark.sparkContext.master.split("[")[0] != "local":
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


def cut(df: DataFrame) -> DataFrame:
    """df, written once as Parquet to the shared folder and read from there: lost executors cost nothing twice, columns are pruned
    and sizes are known."""
    spark = df.sparkSession
    path = scratch(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
