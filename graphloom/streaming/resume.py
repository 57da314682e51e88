"""Resumable extraction: chunks as a file stream, worked off in batches with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def process_available(
    spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, work: Callable[[DataFrame], DataFrame], files_per_batch: int = 1
) -> None:
    """Runs ``work`` over the files of ``source`` that no earlier call has finished and appends to ``target``.

    A batch is written below its own number in overwrite mode, so one that is repeated after
    a failure replaces itself.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{target}/batch_id={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def results(spark: SparkSession, target: str) -> DataFrame:
    """All batches together, those of earlier runs too."""
    return spark.read.parquet(target)
