"""Near-duplicates, substring dedup and top-k against brute force."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.llm import components, near_dup, substring_dedup, topk

ROWS = "doc_id long, text string, th string, cls string, label string, spans string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], ROWS)


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    base = [[word() for _ in range(rng.randrange(1, 140))] for _ in range(n // 3)]
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(n):
        words = list(base[rng.randrange(len(base))])
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = word()
        if i % 9 == 0:
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[rng.randrange(8) :]
        rows.append((i, " ".join(words)))
    return rows + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "One"), (n + 4, "one"), (n + 5, "a b"), (n + 6, "A\tB")]


def brute_components(rows, size, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)}


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates_against_brute_force(spark, size):
    rows = corpus(size)
    got = near_dup.near_duplicates(documents(spark, rows), size, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, size, 80)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_crowded_groups_and_nodes(spark, monkeypatch):
    """Groups too large for a task and crowded nodes give the same components."""
    for name, value in (("GROUP_CLASSES", 12), ("NODE", 4), ("PIVOTS", 3), ("SHARD", 8)):
        monkeypatch.setattr(near_dup, name, value)
    rows = corpus(11, 150)
    got = near_dup.near_duplicates(documents(spark, rows), 4, 80).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, 4, 80)


def test_near_duplicates_odd_rows(spark):
    rows = [(1, "a b c d e f")] * 3 + [(None, "a b c d e f"), (None, "x y z u v w"), (None, None), (7, "q " * 5000)]
    got = near_dup.near_duplicates(documents(spark, rows), 5, 80).collect()
    assert len(got) == 7
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got if r["n_shingles"]} == {(1, 1, True), (None, 1, False), (None, None, True), (7, 7, True)}
    assert near_dup.near_duplicates(documents(spark, []), 5, 80).count() == 0


def test_confirmed_tests_all_pairs():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 30, 12)).astype(np.uint64) for _ in range(60)]
    label = near_dup.confirmed(sets, 60)
    want = np.arange(60)
    for i in range(60):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 60 * (len(sets[i]) + len(sets[j]) - both):
                want[want == want[i]] = want[j]
    assert all((label[i] == label[j]) == (want[i] == want[j]) for i in range(60) for j in range(60))


def test_components(spark):
    rng = random.Random(2)
    pairs = [(f"{i:03}", f"{i + 1:03}") for i in range(80) if i % 9] + [(f"{rng.randrange(200, 260):03}", f"{rng.randrange(200, 260):03}") for _ in range(30)]
    got = {r["node"]: r["label"] for r in components.connected_components(spark.createDataFrame(pairs, "a string, b string")).collect()}
    want = {x: x for p in pairs for x in p}
    for _ in want:
        for a, b in pairs:
            want[a] = want[b] = min(want[a], want[b])
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {x: l for x, l in want.items() if x in linked}
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def brute_spans(rows, window):
    first = {}
    words = {i: (t or "").encode().split() for i, t in rows}
    for i in sorted(words):
        for j in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][j : j + window]), i)
    out = {}
    for i, w in words.items():
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < i:
                gone |= set(range(j, j + window))
        out[i] = (len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode())
    return out


@pytest.mark.parametrize("window,k", [(50, 12), (10, 4)])
def test_substrings_against_brute_force(spark, window, k):
    rows = corpus(window, 150) + [(500, "z " * 400), (501, "z " * 60 + "y"), (502, "a b " * 90)]
    got = substring_dedup.dedup_substrings(documents(spark, rows), window, k).collect()
    assert {r["doc_id"]: (r["_n_words"], r["_n_removed"], r["_kept"]) for r in got} == brute_spans(rows, window)
    assert sum(r["_n_removed"] for r in got) > 500


def test_substrings_odd_rows(spark):
    t = " ".join(f"v{i}" for i in range(60))
    rows = [(3, t), (3, t), (3, t + " x"), (None, t), (None, None), (4, t)]
    got = substring_dedup.dedup_substrings(documents(spark, rows)).collect()
    assert sorted((r["doc_id"] or 0, r["_n_removed"]) for r in got) == [(0, 0), (0, 0), (3, 0), (3, 0), (3, 0), (4, 60)]
    assert len(got[0]) == 9 and substring_dedup.dedup_substrings(documents(spark, [])).count() == 0


def brute_topk(q, p, k):
    out = []
    for qi, qv in q:
        scored = sorted((-sum(a * b for a, b in zip(qv, pv)), pi) for pi, pv in p if pi != qi)[:k]
        out += [(qi, r, pi, -s) for r, (s, pi) in enumerate(scored, 1)]
    return sorted(out)


def clusters(rng, n, spread=4, dims=16, seeds=12):
    centres = rng.normal(0, 200, (seeds, dims))
    return np.rint(np.repeat(centres, n // seeds, axis=0) + rng.normal(0, spread, (n // seeds * seeds, dims))).astype(int)


@pytest.mark.parametrize("kind", ["even", "clustered", "alike"])
def test_topk_against_brute_force(spark, monkeypatch, kind):
    for name, value in (("BLOCK", 64), ("CELLS", 10), ("SAMPLE", 200), ("LEAF", 8)):
        monkeypatch.setattr(topk, name, value)
    rng = np.random.default_rng(1)
    x = rng.integers(-6, 7, (700, 8)) if kind == "even" else clusters(rng, 700)
    if kind == "alike":
        x[100:400] = x[100]
    p = [(i, v) for i, v in enumerate(x.tolist())]
    q = [r for r in p if r[0] % 20 == 0]
    schema = "{} long, v array<long>"
    got = topk.top_k(spark.createDataFrame(q, schema.format("query_id")), spark.createDataFrame(p, schema.format("vec_id")), 7)
    assert sorted(map(tuple, got.collect())) == brute_topk(q, p, 7)


def test_cells_out_of_reach_are_not_visited(spark, monkeypatch):
    for name, value in (("BLOCK", 128), ("SAMPLE", 1200)):
        monkeypatch.setattr(topk, name, value)
    visited = []
    visit = topk._visit
    monkeypatch.setattr(topk, "_visit", lambda q, p, pairs, *rest: visited.append(pairs) or visit(q, p, pairs, *rest))
    x = clusters(np.random.default_rng(4), 1200, dims=64)
    p = [(i, v) for i, v in enumerate(x.tolist())]
    q = [r for r in p if r[0] % 2 == 0]
    schema = "{} long, v array<long>"
    got = topk.top_k(spark.createDataFrame(q, schema.format("query_id")), spark.createDataFrame(p, schema.format("vec_id")), 5)
    assert sorted(map(tuple, got.collect())) == brute_topk(q, p, 5)
    assert sum(int(v.sum()) for v in visited) < 0.5 * visited[0].size


@pytest.mark.parametrize("asked", [100, 1000])
def test_few_queries_prune_cells_at_the_default_constants(spark, monkeypatch, asked):
    visited, visit = [], topk._visit
    monkeypatch.setattr(topk, "_visit", lambda q, p, pairs, *rest: visited.append(pairs) or visit(q, p, pairs, *rest))
    x = clusters(np.random.default_rng(6), 20_000, seeds=20)
    v = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "vec_id long, v array<long>")
    got = {}
    for r in topk.top_k(v.where(F.col("vec_id") % (20_000 // asked) == 0).withColumnRenamed("vec_id", "query_id"), v, 5).collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
    assert visited[0].size >= 200 and sum(int(m.sum()) for m in visited) < 0.5 * visited[0].size
    for i in range(0, 20_000, 1000):
        s = x @ x[i]
        want = sorted((-int(s[j]), j) for j in np.argpartition(-s, 8)[:12] if j != i)[:5]
        assert sorted(got[i]) == want


def test_topk_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (20, [0.25, -0.5]), (20, [0.25, -0.5]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [1.0]), (None, [1.0, 1.0]), (6, [])]
    v = spark.createDataFrame(rows, "vec_id long, e array<float>").select("vec_id", topk.scaled(F.col("e")).alias("v"))
    got = topk.top_k(v.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id"), v, 4)
    want = [(0, 1, 5, 4096), (0, 2, 6, 0), (0, 3, 20, 0), (0, 4, 20, 0), (20, 1, 5, 1024), (20, 2, 0, 0), (20, 3, 6, 0)]
    assert sorted(map(tuple, got.collect())) == want
    none = v.limit(0)
    assert topk.top_k(none.withColumnRenamed("vec_id", "query_id"), none, 3).count() == 0
    assert topk.top_k(v.where("vec_id = 0").withColumnRenamed("vec_id", "query_id"), none, 3).count() == 0


def test_topk_agrees_with_its_sql_on_repeated_rows(spark, tmp_path):
    import duckdb

    from graphloom.llm import queries

    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(0, 1, 4).tolist()) for i in range(80)]
    rows += rows[:30] + rows[:5] * 25 + [(20, rows[3][1]), (40, None), (60, [None] * 4)] + [(i, rows[0][1]) for i in range(100, 160)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = con.sql(queries.OP6_SQL)
    got = queries.op6_dual_tree(spark, str(tmp_path)).select(*want.columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_dual_tree_skips_work():
    rng = np.random.default_rng(3)
    p = clusters(rng, 1200).astype(float)
    ids = np.arange(len(p))
    found = topk.Search(p[::5], p, ids[::5], ids, 5)
    assert len(found.a.centre) > 10 and len(found.b.centre) > 10
    assert found.skipped > 500 and found.scored < 0.3 * 240 * 1200
    for row, i in enumerate(ids[::5].tolist()):
        s = p @ p[i]
        s[i] = -np.inf
        assert [b[1] for b in found.best[row]] == sorted(ids.tolist(), key=lambda j: (-s[j], j))[:5]


def test_trees_cover_their_points():
    x = clusters(np.random.default_rng(8), 600).astype(float)
    tree = topk.Tree(x)
    leaves = [p for p, c in zip(tree.points, tree.children) if not c]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(len(x)))
    for centre, radius, points in zip(tree.centre, tree.radius, tree.points):
        assert np.sqrt(((x[points] - x[centre]) ** 2).sum(axis=1)).max() <= radius + 1e-6


def test_hashes_of_windows_are_of_words():
    from graphloom.llm.words import Runs, Tokens

    texts = ["a b c a b\tc d", None, "", " \n", "\x0bÄrger  a\u00a0b ", "x"]
    tokens = Tokens(texts)
    words = [(t or "").encode().split() for t in texts]
    assert tokens.counts.tolist() == [len(w) for w in words]
    assert [bytes(tokens.spelled(i, i + 1)) for i in range(len(tokens.ends))] == [x for w in words for x in w]
    h = Runs(tokens.hashes).hash(np.arange(5), np.arange(5) + 3)
    assert h[0] == h[3] and len(set(h.tolist())) == 4
    assert tokens.hashes[0] == tokens.hashes[3] and len(set(tokens.hashes.tolist())) == 7
    assert Tokens(["A bÄ"], lower=True).hashes.tolist() == Tokens(["a bÄ"]).hashes.tolist()
    assert Tokens([]).hashes.tolist() == []


def test_long_texts_are_hashed_piece_by_piece(monkeypatch):
    from graphloom.llm import words

    rng = random.Random(3)
    text = " ".join("w" * rng.randrange(1, 40) + str(rng.randrange(99)) for _ in range(900))
    whole = words.Tokens([text]).hashes
    monkeypatch.setattr(words, "_PIECE", 50)
    assert (words.Tokens([text]).hashes == whole).all()
