"""Keyed tables that are updated in part: rows lie in buckets of their key's hash, and an upsert rewrites the touched buckets only.

Each upsert writes these buckets under a new version and then a manifest that says which version of each bucket holds. A
manifest counts once its writer has finished, so an upsert that is killed leaves the table as it was, and readers see a whole old
or a whole new state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..sources import artifacts
from .kg import upsert

BUCKETS = 64


class Keyed:
    """A table below ``root`` with one row a key (columns ``key``); ``touched`` holds the buckets of the last upsert."""

    def __init__(self, spark: SparkSession, root: str, *key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.buckets = spark, root, key, buckets
        self.touched: list[int] = []

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def version(self) -> int:
        """The number of the last finished manifest; 0 before the first."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest")
        fs = path.getFileSystem(conf)
        if not fs.exists(path):
            return 0
        names = (s.getPath().getName() for s in fs.listStatus(path))
        return max((int(x) for x in names if x.isdigit() and artifacts.exists(self.spark, self.root, f"manifest/{x}/_SUCCESS")), default=0)

    def _held(self, version: int) -> dict[int, int]:
        """The version of each bucket that has rows."""
        if not version:
            return {}
        return {r["bucket"]: r["version"] for r in self.spark.read.parquet(f"{self.root}/manifest/{version}").collect()}  # a row a bucket

    def _of(self, held: dict[int, int], schema) -> DataFrame:
        paths = [f"{self.root}/data/{v}/bucket={b}" for b, v in sorted(held.items())]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self) -> DataFrame:
        """All rows of the last finished upsert."""
        version = self.version()
        if not version:
            raise ValueError(f"no table below {self.root}")
        held = self._held(version)
        first = next(iter(sorted(held.items())), None)
        if first is None:
            return self.spark.read.parquet(f"{self.root}/data/{version}")
        return self._of(held, self.spark.read.parquet(f"{self.root}/data/{first[1]}/bucket={first[0]}").schema)

    def upsert(self, new: DataFrame) -> None:
        """Puts new rows in the place of those of equal keys, and beside all others. Of new rows of one key the one with the greatest columns stays."""
        rest = [c for c in new.columns if c not in self.key]
        one = new.groupBy(*self.key).agg(F.max(F.struct(*rest)).alias("_r")).select(*self.key, "_r.*") if rest else new.distinct()
        one = cut(one.select(*new.columns))
        version = self.version()
        held = self._held(version)
        self.touched = sorted(r[0] for r in one.select(self._bucket().alias("b")).distinct().collect())
        old = self._of({b: held[b] for b in self.touched if b in held}, one.schema)
        merged = upsert(old, one, *self.key).withColumn("bucket", self._bucket())
        merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/data/{version + 1}")
        rows = sorted((held | {b: version + 1 for b in self.touched}).items())
        self.spark.createDataFrame(rows, "bucket int, version int").coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/{version + 1}")
