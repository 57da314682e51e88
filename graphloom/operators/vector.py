"""Embeddings and vector search.

Search compares a stated set of queries with all vectors. Groups of queries meet blocks of vectors in tasks of bounded size, and
each keeps only its best k of each query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache
from hashlib import md5

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut
from ..functions.text import tokenize

QUERY_GROUP, VECTOR_BLOCK = 4096, 8192
DIM = 64


def hashed_embedding(c: Column, dim: int = DIM) -> Column:
    """The offline default: counts of words hashed to ``dim`` places, scaled to length 1 (all zeros without words).

    A batch's different words are hashed once each.
    """
    return _counted(dim)(tokenize(c))


@cache
def _counted(dim: int):
    def count(words: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False)
        coded = words.flatten().dictionary_encode()
        place = np.fromiter((int.from_bytes(md5(w.encode()).digest()[:4]) % dim for w in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        at = place[coded.indices.to_numpy(zero_copy_only=False)]
        n = np.bincount(np.repeat(np.arange(len(sizes)), sizes) * dim + at, minlength=len(sizes) * dim).reshape(-1, dim).astype(float)
        x = n / np.maximum(np.sqrt((n * n).sum(axis=1, keepdims=True)), 1e-300)
        return pa.ListArray.from_arrays(np.arange(len(sizes) + 1, dtype=np.int32) * dim, x.ravel())

    count.__annotations__ = {"words": pa.Array, "return": pa.Array}
    return F.arrow_udf(count, "array<double>")


def embed(df: DataFrame, text: str, model: Callable[[list[str]], np.ndarray], batch: int = 16) -> DataFrame:
    """df with ``embedding`` from any model of a list of strings, in batches, scaled to length 1."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            texts = b.column(text).to_pylist()
            parts = [np.asarray(model([t or "" for t in texts[i : i + batch]]), np.float32) for i in range(0, len(texts), batch)]
            x = np.concatenate(parts) if parts else np.empty((0, 0), np.float32)
            x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12) if len(x) else x
            yield pa.record_batch([*b.columns, pa.array(list(x), pa.list_(pa.float32()))], names=[*b.schema.names, "embedding"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in df.schema.fields)
    return df.mapInArrow(run, f"{fields}embedding array<float>")


def _matrix(column) -> np.ndarray:
    """Equal-length vectors of an Arrow list column, as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "idx")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "idx", "score")


def inner(a: str, b: str) -> Column:
    """The inner product of two columns of equally long vectors, in double precision, to nine decimals."""
    return F.round(F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x), 9)


def fitted_centres(vectors: DataFrame, n: int, cells: int, fit_rows: int, seed: int) -> np.ndarray:
    """Centres of k-means on at most about ``fit_rows`` vectors; as many as are given, or fewer."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    share = min(1.0, fit_rows / max(1, n))
    sample = vectors.where(F.pmod(F.xxhash64("idx"), F.lit(1 << 30)) < int(share * (1 << 30)))
    rows = sample.select(array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    if cells < 2:
        from pyspark.ml.stat import Summarizer

        return np.array([rows.select(Summarizer.mean(F.col("v")).alias("m")).first()["m"].toArray()])
    return np.array(KMeans(k=cells, seed=seed, maxIter=10, featuresCol="v").fit(rows).clusterCenters())


def usable(vectors: DataFrame) -> DataFrame:
    """(idx, embedding) without nulls and empty vectors, written once."""
    return cut(vectors.where("idx is not null and embedding is not null and size(embedding) > 0").select(F.col("idx").cast("long"), F.col("embedding").cast("array<float>").alias("embedding")))


def exact(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, idx, score): inner products of (query_id, embedding) with all (idx, embedding); ties to the smaller idx.

    Up to QUERY_GROUP queries go to every task, which keeps the k best of each over all vectors it reads. Beyond, groups of
    queries meet blocks of vectors, both of bounded size, and each pair gives k rows a query.
    """
    base = vectors.where("idx is not null and embedding is not null and size(embedding) > 0").select(F.col("idx").cast("long"), "embedding")
    q = cut(queries.where("embedding is not null").select(F.col("query_id").cast("long"), "embedding"))
    asked = q.count()
    if asked <= QUERY_GROUP:
        rows = q.collect()
        ids, x = np.array([r["query_id"] for r in rows], np.int64), np.array([r["embedding"] for r in rows], np.float64)
        return _ranked(base.mapInArrow(_task_best(ids, x, k), "query_id long, idx long, score double"), k)
    base = cut(base)
    groups, blocks = (max(1, -(-df.count() // size)) for df, size in ((q, QUERY_GROUP), (base, VECTOR_BLOCK)))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = q.withColumn("g", F.pmod(F.xxhash64("query_id"), F.lit(groups)).cast("int")).withColumn("b", every(blocks))
    v = base.withColumn("b", F.pmod(F.xxhash64("idx"), F.lit(blocks)).cast("int")).withColumn("g", every(groups))
    return _ranked(q.groupBy("g", "b").cogroup(v.groupBy("g", "b")).applyInPandas(_block_best(k), "query_id long, idx long, score double"), k)


class Best:
    """The k best of each of n queries so far, ties to the smaller idx: row (a query's place), idx, score. A score of -inf is none."""

    def __init__(self, n: int, k: int):
        self.k, self.kth = k, np.full(n, -np.inf)
        self.row, self.idx, self.score = (np.empty(0, t) for t in (np.int64, np.int64, np.float64))

    def add(self, own: np.ndarray, got: np.ndarray) -> None:
        """got: (queries, candidates) scores of the candidates ``own``."""
        k = self.k
        least = np.maximum(self.kth, np.partition(got, -k, axis=1)[:, -k]) if got.shape[1] > k else self.kth
        r, c = np.nonzero((got >= least[:, None]) & (got > -np.inf))
        row, idx, score = np.concatenate([self.row, r]), np.concatenate([self.idx, own[c]]), np.concatenate([self.score, got[r, c]])
        order = np.lexsort((idx, -score, row))
        row, idx, score = row[order], idx[order], score[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        last = place == k - 1
        self.kth[row[last]] = score[last]
        self.row, self.idx, self.score = row[place < k], idx[place < k], score[place < k]


def _task_best(ids: np.ndarray, x: np.ndarray, k: int):
    """The k best of all vectors of a task for each query, ties to the smaller idx."""
    def run(batches: Iterator[pa.RecordBatch]):
        best = Best(len(x), k)
        for b in batches:
            if not b.num_rows or not len(x):
                continue
            own, v = b.column("idx").to_numpy(), _matrix(b.column("embedding"))
            for lo in range(0, len(own), 2048):
                best.add(own[lo : lo + 2048], np.round(x @ v[lo : lo + 2048].T, 9))
        yield pa.record_batch([pa.array(ids[best.row]), pa.array(best.idx), pa.array(best.score)], names=["query_id", "idx", "score"])

    return run


def _block_best(k: int):
    """Within a block: the k best vectors of each query, ties to the smaller idx."""
    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        found = {"query_id": [], "idx": [], "score": []}
        if len(queries) and len(block):
            block = block.sort_values("idx")  # so that of equal scores the first have the smaller idx
            x, ids = np.stack(block["embedding"].to_numpy()).astype(np.float64), block["idx"].to_numpy()
            for some in (queries.iloc[i : i + 512] for i in range(0, len(queries), 512)):
                score = np.round(np.stack(some["embedding"].to_numpy()).astype(np.float64) @ x.T, 9)
                kth = np.partition(score, -k, axis=1)[:, -k] if score.shape[1] > k else np.full(len(score), -np.inf)
                row, col = np.nonzero(score >= kth[:, None])
                order = np.lexsort((col, -score[row, col], row))
                row, col = row[order], col[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                row, col = row[place < k], col[place < k]
                for name, values in (("query_id", some["query_id"].to_numpy()[row]), ("idx", ids[col]), ("score", score[row, col])):
                    found[name].append(values)
        return pd.DataFrame({c: np.concatenate(v) if v else v for c, v in found.items()})

    return run


class Exact:
    """All vectors, compared with every query; the table is stored as it is."""

    def __init__(self, table: DataFrame):
        self.table = table

    @classmethod
    def build(cls, vectors: DataFrame, root: str | None = None) -> Exact:
        if root:
            vectors.select(F.col("idx").cast("long"), "embedding").write.mode("overwrite").parquet(f"{root}/vectors")
            return cls.load(vectors.sparkSession, root)
        return cls(vectors)

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> Exact:
        return cls(spark.read.parquet(f"{root}/vectors"))

    def search(self, queries: DataFrame, k: int = 5) -> DataFrame:
        return exact(queries, self.table, k)


def _backends() -> dict[str, type]:
    from .inverted_file import InvertedFile
    from .neighbor_graph import NeighborGraph

    return {"exact": Exact, "graph": NeighborGraph, "ivf": InvertedFile}


#: The names of the stores: classes that ``build`` from (idx, embedding) below a folder, ``load`` from there and ``search``.
BACKENDS = ("exact", "graph", "ivf")


def backend(name: str) -> type:
    """A registered store; names ignore case and blanks."""
    key = name.strip().lower()
    if key not in BACKENDS:
        raise ValueError(f"unknown backend {name!r}; there are {', '.join(BACKENDS)}")
    return _backends()[key]


def search(name: str, queries: DataFrame, vectors: DataFrame, k: int = 5, **how) -> DataFrame:
    """Search by a registered store that is built for it; ``how`` goes to its ``build``."""
    return backend(name).build(vectors, **how).search(queries, k)
