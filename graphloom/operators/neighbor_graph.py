"""A stored neighbour graph: approximate search that walks from vector to vector.

Each vector knows about ``DEGREE`` near ones. The graph begins with the nearest within blocks of the order along random directions and is
refined in rounds of joins: vectors that share a neighbour meet there and learn of each other. A search keeps, for each query, a beam
of the best vectors seen; in each round the neighbours of the beam's open vectors are fetched by one join, until no vector of the beam is
open. It begins at the entries of the cells (of k-means on a bounded sample) whose centres are nearest, so
that clusters the graph does not connect are reached, too.

Nodes are partitioned on disk by cell and every link names its cell: a round scans the partitions its links lead to and no other.

A search that is to be ``complete`` takes the k-th score it has found as a bound: the cells whose ball may hold as good a score are compared
with all queries, and no neighbour is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lineage import cut, scratch
from . import vector

DEGREE = 16
#: Vectors of a block that are compared with each other at the start, and how many directions deal them.
BLOCK, DIRECTIONS = 512, 3
#: Rounds of refinement at most; fewer if a round changes less than this share of the links.
ROUNDS, SETTLED = 6, 0.01
_NODE = "cell int, idx long, embedding array<float>, near array<struct<cell:int,idx:long>>"


def _best(links: DataFrame, degree: int) -> DataFrame:
    """(idx, other, score): the best links of each vector."""
    once = links.groupBy("idx", "other").agg(F.max("score").alias("score"))
    order = Window.partitionBy("idx").orderBy(F.desc("score"), "other")
    return once.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= degree).drop("_r")


def _along(direction: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if b.num_rows:
                yield pa.record_batch([*b.columns, pa.array(vector._matrix(b.column("embedding")) @ direction)], names=[*b.schema.names, "at"])

    return run


def _nearest_in_block(degree: int):
    """Links within pieces of a sorted partition."""
    def run(batches: Iterator[pa.RecordBatch]):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def linked():
            idx, x = (np.concatenate(c) for c in zip(*held, strict=True))
            for lo in range(0, len(idx), BLOCK):
                lo = max(0, min(lo, len(idx) - BLOCK))  # the last block reaches back
                i, s = idx[lo : lo + BLOCK], x[lo : lo + BLOCK] @ x[lo : lo + BLOCK].T
                np.fill_diagonal(s, -np.inf)
                k = min(degree, len(i) - 1)
                if k > 0:
                    at = np.argpartition(-s, k - 1, axis=1)[:, :k]
                    yield pa.record_batch([pa.array(np.repeat(i, k)), pa.array(i[at].ravel()), pa.array(np.take_along_axis(s, at, 1).ravel())], names=["idx", "other", "score"])

        for b in batches:
            held.append((b.column("idx").to_numpy(), vector._matrix(b.column("embedding"))))
            if sum(len(i) for i, _ in held) >= 16 * BLOCK:
                yield from linked()
                held = []
        if held:
            yield from linked()

    return run


def _introduced(batches: Iterator[pa.RecordBatch]):
    """Vectors that share a neighbour: links better than the worst that either has."""
    for b in batches:
        out: list[tuple] = []
        for members in b.column("members"):
            idx = members.values.field("idx").to_numpy()
            worst = members.values.field("worst").to_numpy()
            x = vector._matrix(members.values.field("embedding"))
            s = x @ x.T
            row, col = np.nonzero((s > worst[:, None]) & (idx[:, None] != idx))
            out.append((idx[row], idx[col], s[row, col]))
        if out:
            yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["idx", "other", "score"])


def linked(base: DataFrame, degree: int = DEGREE, seed: int = 7) -> DataFrame:
    """(idx, other, score): about the ``degree`` nearest of each of (idx, embedding), by inner product."""
    n = base.count()
    first = base.first()
    kinds = "idx long, other long, score double"
    if first is None:
        return base.sparkSession.createDataFrame([], kinds)
    rng = np.random.default_rng(seed)
    found = None
    for _ in range(DIRECTIONS if n > BLOCK else 1):
        along = base.mapInArrow(_along(rng.normal(size=len(first["embedding"]))), "idx long, embedding array<float>, at double")
        parts = along.repartitionByRange(max(1, n // (4 * BLOCK)), "at", "idx").sortWithinPartitions("at", "idx")
        some = parts.select("idx", "embedding").mapInArrow(_nearest_in_block(degree), kinds)
        found = some if found is None else found.unionByName(some)
    links = cut(_best(found, degree))
    for _ in range(ROUNDS if n > BLOCK else 0):
        worst = links.groupBy("idx").agg(F.when(F.count("*") >= degree, F.min("score")).otherwise(float("-inf")).alias("worst"))
        # each vector stands at its neighbours and at as many of those it is a neighbour of
        back = links.withColumn("_r", F.row_number().over(Window.partitionBy("other").orderBy(F.desc("score"), "idx"))).where(F.col("_r") <= degree)
        at = links.select(F.col("idx").alias("at"), F.col("other").alias("idx")).union(back.select("other", "idx")).distinct()
        members = at.join(base, "idx").join(worst, "idx").groupBy("at").agg(F.collect_list(F.struct("idx", "worst", "embedding")).alias("members"))
        new = _best(links.unionByName(members.select("members").mapInArrow(_introduced, kinds)), degree)
        new = cut(new)
        changed = new.join(links.select("idx", "other"), ["idx", "other"], "left_anti").count()
        links = new
        if changed <= SETTLED * degree * n:
            break
    return links


class NeighborGraph:
    """A graph below ``root``; ``work`` holds, after a search, how many rounds it took and how many vectors it scored."""

    def __init__(self, spark: SparkSession, root: str, beam: int = 64, width: int = 32, starts: int = 16, complete: bool = False):
        self.spark, self.root, self.beam, self.width, self.starts, self.complete = spark, root, beam, width, starts, complete
        rows = sorted(spark.read.parquet(f"{root}/entries").collect())
        self.centres = np.array([r["centre"] for r in rows], np.float64).reshape(len(rows), len(rows[0]["centre"]) if rows else 0)
        self.entries = np.array([[r["cell"], r["idx"]] for r in rows], np.int64).reshape(-1, 2)
        self.radii = np.array([r["radius"] if "radius" in r else np.inf for r in rows], np.float64)
        self.work: dict[str, int] = {}

    @classmethod
    def build(cls, vectors: DataFrame, root: str | None = None, degree: int = DEGREE, cells: int | None = None, fit_rows: int = 100_000, seed: int = 7, **how) -> NeighborGraph:
        """Writes the graph below ``root`` (a scratch folder if none is given); ``how`` goes to the search."""
        spark = vectors.sparkSession
        root = root or scratch(spark, "graph")
        base = vector.usable(vectors)
        n = base.count()
        centres = vector.fitted_centres(base, n, cells or min(1024, max(1, round(n**0.5 / 2))), fit_rows, seed) if n else np.empty((0, 1))
        links = linked(base, degree, seed)
        celled = cut(base.mapInArrow(_celled(centres), "idx long, embedding array<float>, cell int, far double"))
        # a link leads both ways; the way back is kept for the ``degree`` best that come
        back = links.select(F.col("other").alias("idx"), F.col("idx").alias("other"), "score")
        order = Window.partitionBy("idx").orderBy(F.desc("score"), "other")
        back = back.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= degree).drop("_r")
        ways = links.unionByName(back).select("idx", "other").distinct()
        named = ways.join(celled.select(F.col("idx").alias("other"), F.col("cell").alias("c")), "other")
        near = named.groupBy("idx").agg(F.array_sort(F.collect_list(F.struct(F.col("c").alias("cell"), F.col("other").alias("idx")))).alias("near"))
        nodes = celled.join(near, "idx", "left").select("cell", "idx", "embedding", F.coalesce("near", F.array().cast("array<struct<cell:int,idx:bigint>>")).alias("near"))
        nodes.repartitionByRange("cell", "idx").write.mode("overwrite").partitionBy("cell").option("maxRecordsPerFile", 1_000_000).parquet(f"{root}/nodes")
        entry = celled.groupBy("cell").agg(F.min(F.struct("far", "idx")).alias("e"), F.max("far").alias("most")).select("cell", "e.idx", "most").collect()
        rows = [(r["cell"], r["idx"], centres[r["cell"]].tolist(), max(0.0, r["most"]) ** 0.5) for r in entry]
        spark.createDataFrame(rows, "cell int, idx long, centre array<double>, radius double").coalesce(1).write.mode("overwrite").parquet(f"{root}/entries")
        return cls(spark, root, **how)

    @classmethod
    def load(cls, spark: SparkSession, root: str, **how) -> NeighborGraph:
        return cls(spark, root, **how)

    def nodes(self, cells: list[int]) -> DataFrame:
        """The nodes of some cells; a filter on the partition column, so nothing else is scanned."""
        return self.spark.read.schema(_NODE).parquet(f"{self.root}/nodes").where(F.col("cell").isin(cells) if cells else F.lit(False))

    def search(self, queries: DataFrame, k: int = 5) -> DataFrame:
        """(query_id, rank, idx, score) of (query_id, embedding): about the k best by inner product (exactly these if ``complete``), ties to the smaller idx."""
        q = queries.where("embedding is not null").select(F.col("query_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding"))
        state = cut(q.mapInArrow(_begun(self.centres, self.entries, self.starts), _STATE))
        rounds = 0
        while True:
            asked = cut(state.where(F.size("ask") > 0).select("query_id", F.inline("ask")))
            cells = [r["cell"] for r in asked.select("cell").distinct().collect()]  # no more than there are centres
            if not cells:
                break
            rounds += 1
            met = asked.join(self.nodes(cells), ["cell", "idx"]).groupBy("query_id").agg(F.collect_list(F.struct("idx", "embedding", "near")).alias("met"))
            moved = state.join(met, "query_id", "left").mapInArrow(_stepped(max(self.beam, k), self.width), _STATE)
            state = cut(moved)
        self.work = {"rounds": rounds, "scored": int(state.agg(F.sum(F.size("seen"))).first()[0] or 0)}
        found = state.select("query_id", F.explode("beam").alias("b")).select("query_id", "b.idx", F.round("b.score", 9).alias("score"))
        if not self.complete:
            return vector._ranked(found, k)
        best = cut(vector._ranked(found, k))
        kth = best.where(F.col("rank") == k).select("query_id", F.col("score").alias("kth"))
        reach = q.join(kth, "query_id", "left").mapInArrow(_reached(self.centres, self.radii, self.entries[:, 0]), "cell int")
        cells = [r["cell"] for r in reach.distinct().collect()]  # no more than there are centres
        self.work["completed"] = len(cells)
        rest = vector.exact(q, self.nodes(cells).select("idx", "embedding"), k)
        # the key is written as a new expression in both parts, as in hybrid.fuse
        parts = [x.select((F.col("query_id") + 0).alias("query_id"), "idx", "score") for x in (best, rest)]
        return vector._ranked(parts[0].unionByName(parts[1]).groupBy("query_id", "idx").agg(F.max("score").alias("score")), k)


_LINK = pa.list_(pa.struct([("cell", pa.int32()), ("idx", pa.int64())]))
_BEAM = pa.list_(pa.struct([("idx", pa.int64()), ("score", pa.float64()), ("near", _LINK)]))
_SCHEMA = pa.schema([("query_id", pa.int64()), ("embedding", pa.list_(pa.float64())), ("beam", _BEAM), ("seen", pa.list_(pa.int64())), ("ask", _LINK)])
#: A query: the best vectors seen (their links only while they are open), all that were ever asked for, and what is asked for next.
_STATE = "query_id long, embedding array<double>, beam array<struct<idx:long,score:double,near:array<struct<cell:int,idx:long>>>>, seen array<long>, ask array<struct<cell:int,idx:long>>"


def _celled(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            x = vector._matrix(b.column("embedding"))
            far = (centres**2).sum(axis=1) - 2 * (x @ centres.T)
            cell = np.argmin(far, axis=1)
            yield pa.record_batch([*b.columns, pa.array(cell, pa.int32()), pa.array(far[np.arange(len(x)), cell] + (x**2).sum(axis=1))], names=[*b.schema.names, "cell", "far"])

    return run


def _reached(centres: np.ndarray, radii: np.ndarray, cells: np.ndarray):
    """The cells of which some query of a task may find a score as good as its k-th."""
    def run(batches: Iterator[pa.RecordBatch]):
        near = np.zeros(len(cells), bool)
        for b in batches:
            if b.num_rows:
                x, kth = vector._matrix(b.column("embedding")), pc.fill_null(b.column("kth"), -np.inf).to_numpy(zero_copy_only=False)
                most = x @ centres.T + np.linalg.norm(x, axis=1)[:, None] * radii
                near |= (most >= kth[:, None] - 1e-6).any(axis=0)
        yield pa.record_batch([pa.array(cells[near], pa.int32())], names=["cell"])

    return run


def _begun(centres: np.ndarray, entries: np.ndarray, starts: int):
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows = []
            for query_id, e in zip(b.column("query_id").to_pylist(), b.column("embedding").to_pylist(), strict=True):
                best = np.argsort(-(centres @ np.array(e)), kind="stable")[:starts] if len(entries) else []
                ask = [{"cell": int(entries[i][0]), "idx": int(entries[i][1])} for i in best]
                rows.append({"query_id": query_id, "embedding": e, "beam": [], "seen": [a["idx"] for a in ask], "ask": ask})
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return run


def _stepped(beam: int, width: int):
    """What was fetched joins the beam; the best open vectors are closed, and what they lead to is asked for."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows = []
            for r in b.to_pylist():
                held, met = r["beam"], r["met"] or []
                if met:
                    scores = np.array([m["embedding"] for m in met], np.float64) @ np.array(r["embedding"])
                    held += [{"idx": m["idx"], "score": s, "near": m["near"]} for m, s in zip(met, scores.tolist(), strict=True)]
                held = sorted(held, key=lambda x: (-x["score"], x["idx"]))[:beam]
                seen, ask = set(r["seen"]), []
                for x in [x for x in held if x["near"] is not None][:width]:
                    for link in x["near"]:
                        if link["idx"] not in seen:
                            seen.add(link["idx"])
                            ask.append(link)
                    x["near"] = None
                # a step that finds nothing new leaves the others of the beam open
                while not ask and (x := next((x for x in held if x["near"] is not None), None)):
                    ask = [link for link in x["near"] if link["idx"] not in seen]
                    seen.update(link["idx"] for link in ask)
                    x["near"] = None
                rows.append({"query_id": r["query_id"], "embedding": r["embedding"], "beam": held, "seen": sorted(seen), "ask": ask})
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return run
