"""Stored answers of extractors, found again by what was asked.

An answer's key is a hash of the model's name, of the text it saw and of the keywords it was given. A build asks only for what has no answer yet,
so a changed corpus or setting asks for the chunks that it changes, a build that broke off goes on with what is missing,
and one that is repeated asks nothing. Answers are appended job by job; a job that fails leaves nothing behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut, scratch
from ..sources import artifacts
from . import extract

_ANSWER = "key string, entities_json string, relations_json string, good boolean, run string"


def keyed(chunks: DataFrame, model: str, limit: int) -> DataFrame:
    """(chunk_idx, content, keywords, key): what an extractor is to see of (chunk_idx, content, keywords), and its key."""
    seen = F.substring(F.coalesce("content", F.lit("")), 1, limit)
    told = F.to_json(F.struct(F.lit(model).alias("model"), seen.alias("text"), F.coalesce("keywords", F.array().cast("array<string>")).alias("keywords")))
    return chunks.select(F.col("chunk_idx").cast("long"), seen.alias("content"), "keywords", F.sha2(told, 256).alias("key"))


def stored(spark: SparkSession, root: str) -> DataFrame:
    """All answers below ``root``, of every run."""
    if not artifacts.exists(spark, root, "answers"):
        return spark.createDataFrame([], _ANSWER)
    return spark.read.schema(_ANSWER).parquet(f"{root}/answers")


def missing(asked: DataFrame, root: str) -> DataFrame:
    """A chunk for each key of ``keyed`` rows that has no good answer yet."""
    known = stored(asked.sparkSession, root).where("good").select("key").distinct()
    one = asked.join(known, "key", "left_anti")
    return one.withColumn("_r", F.row_number().over(Window.partitionBy("key").orderBy("chunk_idx"))).where("_r = 1").drop("_r")


def ask(chunks: DataFrame, root: str, make: Callable[[], extract.Extractor], model: str, limit: int, workers: int, batch: int, attempts: int = 5, wait: float = 1.0, backend: str = "nim") -> DataFrame:
    """(chunk_idx, entities_json, relations_json) of all chunks (chunk_idx, content, keywords), asking for what is missing below ``root``.

    What is missing is worked off in jobs of ``workers`` tasks of ``batch`` chunks each. A call that keeps failing answers nothing and is asked for again by the next build.
    """
    spark, run = chunks.sparkSession, uuid.uuid4().hex
    asked = cut(keyed(chunks, model, limit))
    open_ = missing(asked, root)
    path = scratch(spark, "asked")
    n = open_.count()
    jobs = max(1, -(-n // (workers * batch)))
    open_.withColumn("job", F.pmod(F.xxhash64("key"), F.lit(jobs)).cast("int")).write.partitionBy("job").parquet(path)
    for job in range(jobs if n else 0):
        part = spark.read.schema("chunk_idx long, content string, keywords array<string>, key string, job int").parquet(path).where(F.col("job") == job)
        said = extract.call_extractor(part.select("chunk_idx", "content", "keywords"), make, workers, limit, attempts, wait, backend).select(F.col("chunk_idx").alias("c"), "entities_json", "relations_json")
        good = (F.col("entities_json") != "") & (F.col("relations_json") != "")
        rows = part.select("key", "chunk_idx").join(said, F.col("c") == F.col("chunk_idx")).select("key", "entities_json", "relations_json", good.alias("good"), F.lit(run).alias("run"))
        rows.write.mode("append").parquet(f"{root}/answers")
    # a good answer if there is one, else what this run got
    best = stored(spark, root).where(F.col("good") | (F.col("run") == run)).groupBy("key").agg(F.max_by(F.struct("entities_json", "relations_json"), F.struct("good", "run")).alias("a"))
    return asked.select("chunk_idx", "key").join(best, "key").select("chunk_idx", "a.*")
