"""Exact top-k by inner product: dual-tree search over cover trees.

Queries and candidates are indexed together. The trees' upper level is one net of centres, spread over
a bounded sample of both by farthest-first choice, so that its first centres are a coarser net; each side uses as many as part the
sample's clusters (``SPREAD``), and more if its number of vectors asks for it. A vector belongs to the cell of the nearest
centre, a cell's covering radius is that of all its vectors, and large cells are dealt into parts. In a task,
the cover trees of the queries of one part and of the candidates of another meet; each part's tree is built once (each level's balls are ``1 / BASE`` as
wide as the one above; a ball too small to be worth a node stays among its parent's points). For balls with
centres q, p and radii a, b no inner product is above q.p + a|p| + b|q| + ab; a pair of nodes, and so
a pair of cells, is skipped where that is below the worst k-th score of the node's queries.

Each query cell first meets the candidate cells of the highest bounds, until these hold enough
candidates; the k-th scores found there prune all other pairs of cells before anything is dealt out to them, and
start the search in the tasks that stay. The best k of each query meet in one ranking.

Defined results: a vector that is null or has a null or non-finite component takes
no part, nor does a null id; vectors of fewer components are filled with
zeros; each of several equal candidate rows counts, equal query rows are one query, and
query rows of one id with different vectors are ranked each on its own; a query never meets candidates of its
own id; ties go to the smaller id; fewer than k candidates give fewer rows; empty
tables give no rows; other columns are not read.
"""

from __future__ import annotations

import pickle
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

BASE = 1.3
#: A node of so many points or fewer is a leaf; a ball of so few points or fewer is no node of its own.
LEAF, SMALL = 32, 3
#: About how many vectors one part of a cell holds.
BLOCK = 2048
#: Centres of the upper level, at most, and vectors they are chosen from.
CELLS, SAMPLE = 256, 4096
#: Cells are fine enough where their radius is this part of that of all vectors.
SPREAD = 0.5
#: Points scored at once.
BATCH = 512


def scaled(vector: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) of each component, or null where the vector takes no part."""
    usable = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long")))


class Tree:
    """A cover tree over the rows of x: node i has centre[i] (a row), radius[i], and children[i] or, as a leaf, points[i]."""

    def __init__(self, x: np.ndarray):
        squares = (x**2).sum(axis=1)
        apart = np.sqrt(np.maximum(squares[:, None] + squares - 2 * (x @ x.T), 0))
        self.centre, self.radius, self.children, self.points = [], [], [], []
        work = [(np.arange(len(x)), 0, -1, True)]
        while work:
            idx, centre, parent, split = work.pop()
            far = apart[centre, idx]
            node = len(self.centre)
            self.centre.append(centre)
            self.radius.append(float(far.max()))
            self.children.append([])
            self.points.append(idx)
            if parent >= 0:
                self.children[parent].append(node)
            if split and len(idx) > LEAF and far.max() > 0:
                balls, rest = self._cover(apart, idx, centre, far.max() / BASE)
                work += [(ball, c, node, True) for ball, c in balls]
                if balls and len(rest):
                    work.append((rest, centre, node, False))
        self.radius = np.array(self.radius)
        self.at = x[self.centre]
        self.norm = np.sqrt(squares[self.centre])

    @staticmethod
    def _cover(apart: np.ndarray, idx: np.ndarray, centre: int, reach: float) -> tuple[list[tuple[np.ndarray, int]], np.ndarray]:
        """Balls of ``reach`` around some of the points, and the points of balls too small for a node."""
        balls, rest = [], []
        while len(idx):
            inside = apart[centre, idx] <= reach
            ball, idx = idx[inside], idx[~inside]
            if len(ball) > SMALL:
                balls.append((ball, centre))
            else:
                rest.append(ball)
            if len(idx):
                centre = idx[0]
        return balls, np.concatenate(rest) if rest else np.empty(0, np.int64)


def upper_bounds(q: np.ndarray, a: np.ndarray, p: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(queries, candidates): above every inner product of vectors in the balls of centres q, p and radii a, b."""
    q_norm, p_norm = np.sqrt((q**2).sum(axis=1)), np.sqrt((p**2).sum(axis=1))
    whole = (q_norm.max(initial=0) + a.max(initial=0) + 1) * (p_norm.max(initial=0) + b.max(initial=0) + 1)
    return q @ p.T + a[:, None] * p_norm + q_norm[:, None] * b + a[:, None] * b + 1e-9 * whole


class Search:
    """The k best rows of p for each row of q, by inner product; rows of one id never meet.

    ``kth``: scores below which a query needs nothing. ``seen`` and ``skipped`` count pairs of nodes, ``scored`` pairs of vectors.
    """

    def __init__(self, q: np.ndarray, p: np.ndarray, q_ids: np.ndarray, p_ids: np.ndarray, k: int, kth: np.ndarray | None = None, a: Tree | None = None, b: Tree | None = None):
        self.q, self.p, self.q_ids, self.p_ids, self.k = q, p, q_ids, p_ids, k
        self.kth = np.full(len(q), -np.inf) if kth is None else kth.astype(float)
        self.best: list[list[tuple[int, int]]] = [[] for _ in q_ids]
        self.seen = self.skipped = self.scored = 0
        self.a, self.b = a or Tree(q), b or Tree(p)
        work = [(0, np.zeros(1, np.int64))]
        while work:
            i, nodes = work.pop()
            nodes, _ = self._left(i, nodes)
            if not len(nodes):
                continue
            if not self.a.children[i]:
                self._leaf(i, nodes)
                continue
            # one level down on both sides
            nodes = np.concatenate([self.b.children[j] or [j] for j in nodes.tolist()]).astype(np.int64)
            work += [(c, nodes) for c in self.a.children[i]]

    def _left(self, i: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes that may hold something for a query of node i, best bound first, with their bounds."""
        a, b = self.a, self.b
        upper = upper_bounds(a.at[i : i + 1], a.radius[i : i + 1], b.at[nodes], b.radius[nodes])[0]
        keep = upper >= self.kth[a.points[i]].min()
        self.seen += len(nodes)
        self.skipped += int((~keep).sum())
        order = np.argsort(-upper[keep], kind="stable")
        return nodes[keep][order], upper[keep][order]

    def _leaf(self, i: int, nodes: np.ndarray) -> None:
        mine = self.a.points[i]
        while len(nodes):
            nodes, upper = self._left(i, nodes)
            if not len(nodes):
                return
            sizes = list(accumulate(1 if self.b.children[j] else len(self.b.points[j]) for j in nodes.tolist()))
            take = max(1, sum(s <= BATCH for s in sizes))
            now, nodes = nodes[:take].tolist(), nodes[take:]
            leaves = [self.b.points[j] for j in now if not self.b.children[j]]
            if leaves:
                self._score(mine, np.concatenate(leaves))
            inner = [c for j in now for c in self.b.children[j]]
            nodes = np.concatenate([np.array(inner, np.int64), nodes])

    def _score(self, mine: np.ndarray, cols: np.ndarray) -> None:
        k = self.k
        self.scored += len(mine) * len(cols)
        score = np.where(self.q_ids[mine][:, None] == self.p_ids[cols], -np.inf, self.q[mine] @ self.p[cols].T)
        enough = np.partition(score, -k, axis=1)[:, -k] if len(cols) > k else np.full(len(mine), -np.inf)
        hits, which = np.nonzero(score >= np.maximum(np.maximum(self.kth[mine], enough), -1e300)[:, None])
        cuts = np.searchsorted(hits, np.arange(len(mine) + 1))
        for row in np.flatnonzero(np.diff(cuts)).tolist():
            new, at = which[cuts[row] : cuts[row + 1]], mine[row]
            pairs = self.best[at] + list(zip(score[row, new].astype(np.int64).tolist(), self.p_ids[cols[new]].tolist(), strict=True))
            pairs.sort(key=lambda s: (-s[0], s[1]))
            self.best[at] = pairs[:k]
            if len(pairs) >= k:
                self.kth[at] = max(self.kth[at], pairs[k - 1][0])


def net(x: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` rows of x, each the one farthest from those before."""
    if not len(x):
        return x
    chosen, far = [0], np.sqrt(((x - x[0]) ** 2).sum(axis=1))
    while len(chosen) < most and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.sqrt(((x - x[chosen[-1]]) ** 2).sum(axis=1)))
    return x[chosen]


def spread_cells(x: np.ndarray, centres: np.ndarray) -> int | None:
    """After how many of the centres all of x lie within SPREAD times the distance to the first one alone; None if not before the last.

    Below that many a ball may span several clusters, and no bound can part them; where more do not
    narrow the balls either, finer cells skip nothing.
    """
    far = np.full(len(x), np.inf)
    for i, c in enumerate(centres):
        far = np.minimum(far, np.sqrt(((x - c) ** 2).sum(axis=1)))
        if i == 0:
            whole = far.max(initial=0)
        if far.max(initial=0) <= SPREAD * whole:
            return i + 1
    return None


def _rows(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors of an Arrow list column as rows, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    sizes = np.asarray(column.value_lengths())
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    row = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, place] = flat
    return out


def _cells(centres: np.ndarray):
    """Adds each row's cell and its distance from the centre."""

    def run(batches):
        for b in batches:
            x = _rows(b.column("v"), centres.shape[1]) if b.num_rows else np.empty((0, centres.shape[1]))
            squares = (x**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1) - 2 * (x @ centres.T)
            cell = squares.argmin(axis=1) if len(x) else np.empty(0, np.int64)
            far = np.sqrt(((x - centres[cell]) ** 2).sum(axis=1))
            yield pa.record_batch([*b.columns, pa.array(cell, pa.int32()), pa.array(far)], names=[*b.schema.names, "cell", "far"])

    return run


_FOUND = [("query_id", pa.int64()), ("qh", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())]
_FOUND_DDL = "query_id long, qh long, vec_id long, score long"


_PART = "cell int, part int, a array<long>, b array<long>, x binary, tree binary"


def _planted(width: int, a: str, b: str):
    """The vectors of a part as one row, with their tree: it is built once, however many parts it meets."""
    def run(table: pa.Table) -> pa.Table:
        x = _rows(table.column("v"), width)
        ids = [pa.array([table.column(c).to_pylist()], pa.list_(pa.int64())) for c in (a, b)]
        cell, part = (pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("cell", "part"))
        return pa.table([cell, part, *ids, pa.array([x.tobytes()], pa.binary()), pa.array([pickle.dumps(Tree(x))], pa.binary())], names=["cell", "part", "a", "b", "x", "tree"])

    return run


def _parts(rows: DataFrame, level: _Level, width: int, a: str, b: str, *key: str) -> DataFrame:
    """(cell, part, a, b, x, tree): ids, vectors and tree of each part, written once."""
    return stage(rows.withColumn("part", level.part(*key)).groupBy("cell", "part").applyInArrow(_planted(width, a, b), _PART))


def _search(k: int, width: int):
    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        if not queries.num_rows or not block.num_rows:
            return pa.schema(_FOUND).empty_table()
        one, two = queries.to_pylist()[0], block.to_pylist()[0]
        q, p = (np.frombuffer(r["x"]).reshape(-1, width) for r in (one, two))
        q_ids, qh = np.array(one["a"], np.int64), np.array(one["b"], np.int64)
        known = {(r["query_id"], r["qh"]): r["kth"] for r in one["worst"] or []}
        kth = np.array([known.get(key, -np.inf) for key in zip(one["a"], one["b"])])
        best = Search(q, p, q_ids, np.array(two["a"], np.int64), k, kth, pickle.loads(one["tree"]), pickle.loads(two["tree"])).best
        n = [len(b) for b in best]
        flat = [pair for b in best for pair in b]
        return pa.table([np.repeat(q_ids, n), np.repeat(qh, n), [x[1] for x in flat], [x[0] for x in flat]], schema=pa.schema(_FOUND))

    return run


def first_pairs(bound: np.ndarray, size: np.ndarray, enough: int) -> np.ndarray:
    """For each query cell the candidate cells of the highest bounds that hold ``enough`` vectors together."""
    order = np.argsort(-bound, axis=1, kind="stable")
    before = np.cumsum(size[order], axis=1) - size[order]
    out = np.zeros(bound.shape, bool)
    np.put_along_axis(out, order, before < enough, axis=1)
    return out & (size > 0)


class _Level:
    """The cells of one side: covering radii, sizes, and numbers of parts; at most CELLS rows come to the driver."""

    def __init__(self, rows: DataFrame, cells: int):
        self.radius, self.size = np.zeros(cells), np.zeros(cells, np.int64)
        for r in rows.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect():
            self.radius[r["cell"]], self.size[r["cell"]] = r["far"], r["n"]
        self.parts = np.maximum(1, -(-self.size // BLOCK)).astype(int)

    def part(self, *key: str) -> Column:
        """A row's part of its cell."""
        return F.pmod(F.xxhash64(*key), self.all_parts(F.col("cell"))).cast("int")

    def all_parts(self, cell: Column) -> Column:
        return F.element_at(F.array(*[F.lit(int(n)) for n in self.parts]), cell + 1)


def _visit(q: DataFrame, p: DataFrame, pairs: np.ndarray, of_q: _Level, of_p: _Level, k: int, width: int) -> DataFrame:
    """The best k of each query in each part of the cells paired with its own; q, p: parts, q's with the k-th scores known, ``worst``."""
    spark = q.sparkSession
    # at most CELLS**2 rows of two numbers
    table = F.broadcast(spark.createDataFrame([(int(i), int(j)) for i, j in np.argwhere(pairs)], "qc int, pc int"))
    every = lambda level, cell: F.explode(F.sequence(F.lit(0), level.all_parts(F.col(cell)) - 1))
    key = ["qc", "qp", "pc", "pp"]
    left = q.withColumnsRenamed({"cell": "qc", "part": "qp"}).join(table, "qc").withColumn("pp", every(of_p, "pc"))
    right = p.withColumnsRenamed({"cell": "pc", "part": "pp"}).join(table, "pc").withColumn("qp", every(of_q, "qc"))
    left, right = left.select(*key, "a", "b", "x", "tree", "worst"), right.select(*key, "a", "x", "tree")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_search(k, width), _FOUND_DDL)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id", "qh").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(queries: DataFrame, base: DataFrame, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score); queries: (query_id, v), base: (vec_id, v), v an array of whole numbers."""
    queries = queries.where("query_id is not null and v is not null").select(F.col("query_id").cast("long"), "v").distinct()
    base = base.where("vec_id is not null and v is not null").select(F.col("vec_id").cast("long"), "v")
    both = queries.select(F.col("query_id").alias("id"), "v", F.lit(True).alias("asked")).union(base.toDF("id", "v").withColumn("asked", F.lit(False)))
    n_q, n, width = both.agg(F.count_if("asked"), F.count("*"), F.max(F.size("v"))).first()
    width = max(1, width or 0)
    share = int(min(1.0, SAMPLE / max(1, n)) * (1 << 30))
    some = both.where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share).select("v").limit(SAMPLE).collect()
    sample = [np.pad(np.array(r["v"], float), (0, width - len(r["v"]))) for r in some]
    centres = net(np.array(sample).reshape(-1, width), CELLS)
    centres = centres if len(centres) else np.zeros((1, width))
    # as many cells as part the sample's clusters, if it has any; and as many as the number of vectors asks for
    apart = spread_cells(np.array(sample).reshape(-1, width), centres) or 1
    of_queries, of_base = (centres[: max(apart, -(-rows // (BLOCK // 2)))] for rows in (n_q, n - n_q))
    # Of vectors that are all alike only the k + 1 least ids can be among anyone's best k, and of one such row only k copies
    alike = Window.partitionBy("h", "v").orderBy("vec_id")
    rows = base.withColumn("h", F.xxhash64("v")).groupBy("vec_id", "h", "v").agg(F.least(F.count("*"), F.lit(k)).cast("int").alias("copies"))
    rows = rows.withColumn("no", F.row_number().over(alike)).where(F.col("no") <= k + 1).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    celled = lambda d, to, ddl: stage(d.mapInArrow(_cells(to), f"{ddl}, cell int, far double"))
    p = celled(rows.select("vec_id", "h", "copy", "v"), of_base, "vec_id long, h long, copy int, v array<long>")
    q = celled(queries.select("query_id", F.xxhash64("v").alias("qh"), "v"), of_queries, "query_id long, qh long, v array<long>")
    of_q, of_p = _Level(q, len(of_queries)), _Level(p, len(of_base))
    bound = upper_bounds(of_queries, of_q.radius, of_base, of_p.radius)
    asked = (of_q.size > 0)[:, None] & (of_p.size > 0)
    early = first_pairs(bound, of_p.size, 4 * (k + 1)) & asked
    nothing = F.lit(float("-inf"))
    q_parts, p_parts = _parts(q, of_q, width, "query_id", "qh", "query_id", "qh"), _parts(p, of_p, width, "vec_id", "h", "vec_id", "h", "copy")
    worst_of = "array<struct<query_id:bigint,qh:bigint,kth:double>>"
    found = stage(_ranked(_visit(q_parts.withColumn("worst", F.lit(None).cast(worst_of)), p_parts, early, of_q, of_p, k, width), k))
    kth = found.where(F.col("rank") == k).select("query_id", "qh", F.col("score").cast("double").alias("kth"))
    q = q.join(kth, ["query_id", "qh"], "left").withColumn("kth", F.coalesce("kth", nothing))
    worst = np.full(len(of_queries), np.inf)
    for r in q.groupBy("cell").agg(F.min("kth").alias("kth")).collect():
        worst[r["cell"]] = r["kth"]
    late = asked & ~early & (bound >= worst[:, None])
    if late.any():
        told = q.withColumn("part", of_q.part("query_id", "qh")).groupBy("cell", "part").agg(F.collect_list(F.struct("query_id", "qh", "kth")).alias("worst"))
        known = q_parts.join(told, ["cell", "part"])
        # keys are written as new expressions: a union that takes its parts for equally partitioned can fail once AQE has coalesced one of them
        parts = [d.select((F.col("query_id") + 0).alias("query_id"), (F.col("qh") + 0).alias("qh"), "vec_id", "score") for d in (found, _visit(known, p_parts, late, of_q, of_p, k, width))]
        found = _ranked(parts[0].union(parts[1]), k)
    return found.select("query_id", "rank", "vec_id", "score")
