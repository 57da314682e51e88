"""A stored inverted file: vectors partitioned on disk by their cell, with small codes of their residuals for a first pass.

A search names its cells before it reads, so only their partitions are scanned. The first pass reads idx and code (one byte a
dimension: what a vector is beside its cell's centre) and keeps whatever may be among the k best, as the error of each code is
known; the second pass reads the vectors of these alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.lineage import cut, scratch
from . import vector


class InvertedFile:
    """Cells fitted by k-means on a bounded sample, every vector in its nearest cell.

    Without ``probe`` results are those of the exact search: after the ``FIRST`` cells nearest to a query, all others
    are read whose ball (centre and radius) may hold a score as good as the k-th found. A ``probe`` ends
    the search after so many cells, with whatever recall that gives. ``read`` holds the cells of the last search.
    """

    FIRST = 16
    #: Vectors and queries that meet in one task.
    BLOCK, GROUP = 8192, 4096

    def __init__(self, spark: SparkSession, root: str, probe: int | None = None):
        self.spark, self.root, self.probe = spark, root, probe
        rows = sorted(spark.read.parquet(f"{root}/centres").collect())
        self.centres = np.array([r["centre"] for r in rows], np.float64).reshape(len(rows), len(rows[0]["centre"]) if rows else 0)
        self.radius, self.size = (np.array([r[c] for r in rows]) for c in ("radius", "n"))
        self.read: list[int] = []

    @classmethod
    def build(cls, vectors: DataFrame, root: str | None = None, cells: int | None = None, probe: int | None = None, fit_rows: int = 100_000, seed: int = 7) -> InvertedFile:
        """Writes the file below ``root`` (a scratch folder if none is given). ``fit_rows`` bounds the sample that the centres are fitted on."""
        spark = vectors.sparkSession
        root = root or scratch(spark, "ivf")
        base = vector.usable(vectors)
        n = base.count()
        centres = vector.fitted_centres(base, n, cells or min(128, max(1, n // 10)), fit_rows, seed) if n else np.empty((0, 1))
        table = base.mapInArrow(_coded(centres), "idx long, embedding array<float>, cell int, code binary, step double, miss double, far double")
        # a cell's rows go to a few files of bounded size, whatever the number of tasks
        table.repartitionByRange("cell", "idx").write.mode("overwrite").partitionBy("cell").option("maxRecordsPerFile", 1_000_000).parquet(f"{root}/cells")
        kinds = "cell int, idx long, embedding array<float>, code binary, step double, miss double, far double"
        held = spark.read.schema(kinds).parquet(f"{root}/cells").groupBy("cell").agg(F.max("far").alias("radius"), F.count("*").alias("n")).collect()
        found = {r["cell"]: (r["radius"], r["n"]) for r in held}
        rows = [(i, c.tolist(), *map(float, found.get(i, (float("-inf"), 0)))) for i, c in enumerate(centres)]
        spark.createDataFrame(rows, "cell int, centre array<double>, radius double, n double").coalesce(1).write.mode("overwrite").parquet(f"{root}/centres")
        return cls(spark, root, probe)

    @classmethod
    def load(cls, spark: SparkSession, root: str, probe: int | None = None) -> InvertedFile:
        return cls(spark, root, probe)

    def partitions(self, cells: list[int]) -> DataFrame:
        """The vectors of some cells; a filter on the partition column, so nothing else is scanned."""
        kinds = "cell int, idx long, embedding array<float>, code binary, step double, miss double, far double"
        return self.spark.read.schema(kinds).parquet(f"{self.root}/cells").where(F.col("cell").isin(cells) if cells else F.lit(False))

    def _cells_of(self, queries: DataFrame, first: int, more: bool) -> DataFrame:
        """(query_id, embedding, kth, cell): the ``first`` cells nearest to each query; or ``more``: all others that may hold a score of ``kth``."""
        centres, radius = self.centres, self.radius

        def run(batches: Iterator[pa.RecordBatch]):
            for b in batches:
                if not b.num_rows or not len(centres):
                    continue
                x = vector._matrix(b.column("embedding"))
                dot = x @ centres.T
                far = (centres**2).sum(axis=1) - 2 * dot
                take = np.zeros(dot.shape, bool)
                np.put_along_axis(take, np.argsort(far, axis=1, kind="stable")[:, :first], True, 1)
                if more:
                    bound = dot + radius * np.linalg.norm(x, axis=1)[:, None]
                    take = ~take & (bound >= b.column("kth").to_numpy()[:, None] - 1e-6)
                row, cell = np.nonzero(take & (radius >= 0))
                yield pa.record_batch([*(c.take(pa.array(row)) for c in b.columns), pa.array(cell, pa.int32())], names=[*b.schema.names, "cell"])

        return queries.select("query_id", "embedding", "kth").mapInArrow(run, "query_id long, embedding array<double>, kth double, cell int")

    def _found(self, asked: DataFrame, k: int, queries: int) -> DataFrame:
        """(query_id, idx, score): what may be among a query's k best in the cells it asks for."""
        asked = cut(asked)
        cells = [r["cell"] for r in asked.select("cell").distinct().collect()]  # no more than there are centres
        self.read = sorted({*self.read, *cells})
        groups = max(1, -(-queries // self.GROUP))
        blocks = F.element_at(F.array(*(F.lit(int(max(1, -(-n // self.BLOCK)))) for n in self.size)), F.col("cell") + 1) if len(self.size) else F.lit(1)
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        held = self.partitions(cells)
        q = asked.withColumn("g", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")).withColumn("b", every(blocks))
        v = held.select("cell", "idx", "code", "step", "miss", F.pmod(F.xxhash64("idx"), blocks).cast("int").alias("b"), every(F.lit(groups)).alias("g"))
        key = ["cell", "b", "g"]
        likely = q.groupBy(*key).cogroup(v.groupBy(*key)).applyInPandas(_likely(self.centres, k), "query_id long, cell int, idx long")
        met = likely.join(held.select("cell", "idx", F.col("embedding").alias("v")), ["cell", "idx"]).join(asked.select("query_id", "embedding").distinct(), "query_id")
        return met.select("query_id", "idx", vector.inner("embedding", "v").alias("score"))

    def search(self, queries: DataFrame, k: int = 5) -> DataFrame:
        """As ``vector.exact``; with a ``probe``, within that many cells nearest to each query."""
        self.read = []
        q = cut(queries.where("embedding is not null").select(F.col("query_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")))
        n, low = q.count(), F.lit(float("-inf"))
        near = self.probe or self.FIRST
        first = cut(vector._ranked(self._found(self._cells_of(q.withColumn("kth", low), near, False), k, n), k))
        if self.probe:
            return first
        kth = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
        held = q.join(kth, "query_id", "left").withColumn("kth", F.coalesce("kth", low))
        more = self._found(self._cells_of(held, near, True), k, n)
        # the key is written as a new expression in both parts, as in hybrid.fuse
        parts = [x.select((F.col("query_id") + 0).alias("query_id"), "idx", "score") for x in (first, more)]
        return vector._ranked(parts[0].unionByName(parts[1]), k)


def _coded(centres: np.ndarray):
    """Vectors with their cell, their distance to its centre, the code of what they are beside it, and that code's error."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            x = vector._matrix(b.column("embedding"))
            far = (centres**2).sum(axis=1) - 2 * (x @ centres.T)
            cell = np.argmin(far, axis=1)
            rest = x - centres[cell]
            step = np.maximum(np.abs(rest).max(axis=1), 1e-30) / 127
            code = np.rint(rest / step[:, None]).astype(np.int8)
            miss = np.linalg.norm(rest - step[:, None] * code, axis=1)
            columns = [pa.array(cell, pa.int32()), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(step), pa.array(miss), pa.array(np.linalg.norm(rest, axis=1))]
            yield pa.record_batch([*b.columns, *columns], names=[*b.schema.names, "cell", "code", "step", "miss", "far"])

    return run


def _likely(centres: np.ndarray, k: int):
    """Of the codes of a part of a cell those that may belong to a query's k best."""
    def run(queries: pd.DataFrame, codes: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "cell": [], "idx": []}
        if len(queries) and len(codes):
            cell, idx = int(codes["cell"].iat[0]), codes["idx"].to_numpy()
            code = np.frombuffer(b"".join(codes["code"]), np.int8).reshape(len(codes), -1).astype(np.float32)
            step, miss = codes["step"].to_numpy(), codes["miss"].to_numpy()
            for some in (queries.iloc[i : i + 256] for i in range(0, len(queries), 256)):
                x = np.stack(some["embedding"].to_numpy())
                about = (x @ centres[cell])[:, None] + (x.astype(np.float32) @ code.T) * step
                size = np.linalg.norm(x, axis=1)[:, None]
                error = size * (miss + 1e-5 * step * 127 * code.shape[1]) + 1e-6  # and that of adding in single precision
                low = about - error
                kth = np.partition(low, -k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
                row, col = np.nonzero(about + error >= np.maximum(kth, some["kth"].to_numpy() - 1e-6)[:, None])
                out["query_id"].append(some["query_id"].to_numpy()[row])
                out["cell"].append(np.full(len(row), cell, np.int32))
                out["idx"].append(idx[col])
        return pd.DataFrame({c: np.concatenate(v) if v else np.empty(0, np.int64) for c, v in out.items()})

    return run
