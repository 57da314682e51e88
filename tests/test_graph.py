"""Extraction, merging, graph traversal, retrieval, the whole build, resuming."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom import cli
from graphloom.config import BuildConfig
from graphloom.operators import bm25, extract, graph, hybrid, kg, stats, vector
from graphloom.plans.build import run_build
from graphloom.streaming import resume

ENTITY = "chunk_idx long, pos int, name string, type string, description string"
RELATION = "chunk_idx long, pos int, source string, target string, relation string, description string, weight double"


def test_merge_takes_first_seen_on_ties(spark):
    e = spark.createDataFrame([(0, 0, "N", "B", "d1"), (0, 1, "N", "A", "d1"), (1, 0, "N", "A", "d2"), (2, 0, "N", "B", ""), (3, 0, "N", "C", "d3"), (4, 0, "N", "C", "d4")], ENTITY)
    r = kg.merge_entities(e).first()
    assert (r["entity_type"], r["description"], r["source_chunks"], r["frequency"]) == ("B", "d1 | d2 | d3", [0, 1, 2, 3, 4], 6)


def test_edges_collapse_to_the_relation_seen_last(spark):
    r = spark.createDataFrame([(0, 0, "a", "b", "r1", "x", 0.2), (0, 1, "a", "b", "r2", "y", 0.4), (1, 0, "a", "b", "r1", "z", 0.8)], RELATION)
    m = {x["relation"]: x for x in kg.merge_relations(r).collect()}
    assert m["r1"]["weight"] == pytest.approx(0.5) and m["r1"]["description"] == "x | z"
    assert kg.collapse_edges(kg.merge_relations(r)).first()["relation"] == "r2"


def test_relations_need_both_ends_in_their_chunk(spark):
    e = spark.createDataFrame([(0, 0, "A", "t", ""), (0, 1, "B", "t", ""), (1, 0, "A", "t", "")], ENTITY)
    r = spark.createDataFrame([(0, 0, "A", "B", "r", "", 0.5), (1, 0, "A", "B", "r", "", 0.5), (0, 1, "A", "A", "r", "", 0.5), (0, 2, "A", "", "r", "", 0.5)], RELATION)
    assert [tuple(x)[:4] for x in kg.filter_relations(r, e).select("chunk_idx", "pos", "source", "target").collect()] == [(0, 0, "A", "B")]


def test_mappings_are_inverse(spark):
    e = spark.createDataFrame([(0, 0, "A", "t", ""), (0, 1, "B", "t", ""), (2, 0, "A", "t", ""), (2, 1, "A", "t", "")], ENTITY)
    chunks = spark.createDataFrame([(0,), (1,), (2,)], "chunk_idx long")
    one = {r["chunk_idx"]: r["entities"] for r in kg.chunk_entities(chunks, e).collect()}
    two = {r["name"]: r["chunks"] for r in kg.entity_chunks(e).collect()}
    assert one == {0: ["A", "B"], 1: [], 2: ["A"]} and two == {"A": [0, 2], "B": [0]}


def test_extractor_calls(spark):
    class Model:
        def entities(self, text):
            if "fail" in text:
                raise TimeoutError
            return json.dumps([{"name": w, "type": "T"} for w in text.split()] + [3])

        def relations(self, text, entities):
            return json.dumps([{"source": a["name"], "target": b["name"], "weight": "9"} for a, b in zip(entities, entities[1:])])

    waits = []
    assert extract.with_retry(lambda: 1 / 0, attempts=3, sleep=waits.append) == "" and waits == [1.0, 2.0]
    chunks = spark.createDataFrame([(0, "a b"), (1, "fail"), (2, "")], "chunk_idx long, content string")
    answers = extract.call_extractor(chunks, Model, 2, attempts=2, wait=0.0).cache()
    e, r = extract.parse_entities(answers), extract.parse_relations(answers)
    assert sorted((x["chunk_idx"], x["name"], x["type"]) for x in e.collect()) == [(0, "A", "T"), (0, "B", "T")]
    x = r.first()
    assert (x["source"], x["target"], x["relation"], x["weight"]) == ("A", "B", "liên_quan", 1.0)
    with_keywords = spark.createDataFrame([(0, "a b", ["B", "C"]), (1, "fail", ["D", "E"]), (2, "", None)], "chunk_idx long, content string, keywords array<string>")
    r = extract.parse_relations(extract.call_extractor(with_keywords, Model, 2, attempts=1, wait=0.0))
    assert sorted((x["chunk_idx"], x["source"], x["target"]) for x in r.collect()) == [(0, "A", "B"), (0, "B", "C"), (1, "D", "E")]


def test_phrases(spark):
    text = "Khoản thu phí bảo vệ. Khoản thu phí bảo vệ, thu phí môi trường!\nab thu phí cd"
    c = spark.createDataFrame([(0, text), (1, ""), (2, None), (3, "thuếphímôitrường thuếphímôitrườngx")], "chunk_idx long, content string")
    rows = extract.keywords(c, 4, words=3).orderBy("chunk_idx", "pos").collect()
    assert [r["pos"] for r in rows if r["chunk_idx"] == 0] == [1_000_001 + i for i in range(4)] and {r["chunk_idx"] for r in rows} == {0, 3}
    names = [r["name"] for r in rows if r["chunk_idx"] == 0]
    assert "THU PHÍ" in names and all(len(w) >= 3 for n in names for w in n.split())
    assert len({r["name"] for r in rows if r["chunk_idx"] == 3} & {"THUẾPHÍMÔITRƯỜNG", "THUẾPHÍMÔITRƯỜNGX"}) == 1
    one = extract.keywords(c, 4).where("chunk_idx = 0").orderBy("pos").collect()
    assert len(one) == 4 and all(" " not in r["name"] for r in one)


def keywords_by_loop(text, k):
    import math
    import re
    import string

    seen = {}
    for no, sentence in enumerate(re.split(r"[.!?\n]+", text)):
        for w in sentence.lower().translate(str.maketrans(string.punctuation, " " * len(string.punctuation))).split():
            if len(w) >= 3:
                seen.setdefault(w, []).append(no)
    scores = sorted((round(math.log(math.log(3.0 + s[0]) + 1) / (len(s) * (1 + len(set(s)))), 9), w) for w, s in seen.items())
    return [w.upper() for _, w in scores[:k]]


def test_keywords_are_counted_within_their_chunks(spark):
    import random

    rng = random.Random(3)
    words = ["thu", "phí", "môi", "trường", "ab", "x", "Khoản", "điều", "khoản", "\U0001d538bc"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", " ", ", ", ". ", "\n", "?! "]) for _ in range(rng.choice([0, 1, 8, 60]))) for _ in range(700)] + ["", "...", " a b ", "\n\nthu"]
    c = spark.createDataFrame([*enumerate(texts), (len(texts), None)], "chunk_idx long, content string").coalesce(1)
    found = extract.keywords(c, 4)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in found.orderBy("chunk_idx", "pos").collect():
        got.setdefault(r["chunk_idx"], []).append((r["pos"] - 1_000_001, r["name"]))
    assert got == {i: list(enumerate(want)) for i, t in enumerate(texts) if (want := keywords_by_loop(t, 4))}


@pytest.mark.parametrize("answer,n", [('```json\n[{"name": "a"}, 3]\n```', 1), ('Here: [{"name": "a"}, {"name": "b"}] done', 2), ("null", 0), ("5", 0), ('{"name": "a"}', 0), ("]x[", 0), ("", 0), (None, 0), ("[" * 5000 + "]", 0)])
def test_entities_of_any_answer(answer, n):
    assert len(extract.known_entities(answer)) == n


def test_build_with_an_extractor_goes_on_where_it_broke_off(spark, tmp_path):
    src, out, calls = tmp_path / "texts", str(tmp_path / "out"), tmp_path / "calls"
    src.mkdir()
    calls.mkdir()
    for i in range(4):
        (src / f"{i}_2001_TT_1.txt").write_text("BỘ X\n" + f"Điều 1. Something Important {i} " + "từ " * 90)
    config = BuildConfig(dataset_dir=str(src), output_dir=out, work_dir=str(tmp_path / "work"), kg_backend="gpt", batch_size=1, max_workers=1, keyword_top_k=0)
    with pytest.raises(ValueError):
        run_build(spark, config)
    broken = str(tmp_path / "broken")

    class Model:
        def entities(self, text):
            (calls / f"{len(list(calls.iterdir()))}").write_text(text)
            if "Important 2" in text and not os.path.exists(broken):
                os._exit(1)  # the worker dies
            return '```json\n[{"name": "one", "type": "T"}, {"name": "two", "type": "T"}]\n```'

        def relations(self, text, entities):
            return '[{"source": "one", "target": "two", "relation": "r"}]'

    with pytest.raises(Exception, match=".*"):
        run_build(spark, config, Model, count=len)
    open(broken, "w").close()
    t = run_build(spark, config, Model, embedder=lambda texts: np.ones((len(texts), 3)), count=len)
    assert t["chunks"].count() == t["relations_raw"].count() == 4 and t["edges"].count() == 1
    assert t["chunks"].agg(F.min("tokens")).first()[0] > 200  # characters
    asked = [p.read_text() for p in calls.iterdir()]
    assert len(asked) < 4 + 6 and t["vectors"].first()["embedding"] == pytest.approx([3**-0.5] * 3)
    assert {r["entities"][0] for r in t["chunk_entities"].collect()} == {"ONE"} and t["graph_nodes"].count() == 2


EDGES = [("a", "b"), ("b", "c"), ("d", "c"), ("x", "y")]


@pytest.fixture(scope="module")
def g(spark):
    edges = spark.createDataFrame([(s, t, "r", "", 0.5) for s, t in EDGES], "source string, target string, relation string, description string, weight double")
    return spark.createDataFrame([(n,) for n in "abcdxyz"], "name string"), edges


@pytest.mark.parametrize("depth,want", [(1, {("a", "b")}), (2, {("a", "b"), ("b", "c")}), (3, {("a", "b"), ("b", "c"), ("d", "c")}), (9, {("a", "b"), ("b", "c"), ("d", "c")})])
def test_neighbors(spark, g, depth, want):
    got = graph.neighbors(g[1], spark.createDataFrame([("a",)], "name string"), depth)
    assert {(r["source"], r["target"]) for r in got.collect()} == want


def test_subgraph(spark, g):
    seeds = spark.createDataFrame([("b",), ("unknown",), ("z",)], "name string")
    assert {r["name"] for r in graph.subgraph_nodes(*g, seeds, 1).collect()} == {"a", "b", "c", "z"}
    assert {(r["source"], r["target"]) for r in graph.subgraph_edges(*g, seeds, 1).collect()} == {("a", "b"), ("b", "c")}
    assert graph.subgraph_nodes(*g, seeds.where("name = 'unknown'"), 1).count() == 0
    assert tuple(graph.stats(*g).first()) == (7, 4)


def test_bm25_floor_and_ties(spark):
    chunks = spark.createDataFrame([(0, "x a"), (1, "x b"), (2, "x c"), (3, "")], "chunk_idx long, content string")
    q = spark.createDataFrame([(0, "x"), (1, "none"), (2, "c x x")], "query_id long, query string")
    rows = bm25.top_k(chunks, q, 2).collect()
    assert [(r["query_id"], r["chunk_idx"]) for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"]))] == [(0, 0), (0, 1), (2, 2), (2, 0)]
    idf = {r["term"]: r["idf"] for r in bm25.idf(bm25.postings(chunks), 4).collect()}
    import math

    raw = {t: math.log(4 - d + 0.5) - math.log(d + 0.5) for t, d in (("x", 3), ("a", 1), ("b", 1), ("c", 1))}
    assert idf["x"] == pytest.approx(0.25 * sum(raw.values()) / 4) and idf["a"] == pytest.approx(raw["a"])


def test_fusion_by_priority(spark):
    c = lambda rows: spark.createDataFrame([(0, i + 1, x) for i, x in enumerate(rows)], "query_id long, rank int, chunk_idx long")
    got = hybrid.fuse(c([1, 2]), c([2, 3]), c([4, 5, 6, 7])).orderBy("place").collect()
    assert [r["chunk_idx"] for r in got] == [1, 2, 3, 4, 5, 6]


def test_answers(spark):
    c = spark.createDataFrame([(0, "p0", "c", 1, 2, 3), (1, "bad", "c", 0, 0, 0)], "query_id long, prompt string, context string, num_chunks int, num_entities int, num_relationships int")

    def make():
        return lambda prompt: {"p0": "yes"}[prompt]

    q = spark.createDataFrame([(0, "q0"), (1, "q1"), (2, "q2")], "query_id long, query string")
    rows = {r["query_id"]: r for r in hybrid.evaluation(q, hybrid.answer(c, make, attempts=1)).collect()}
    assert rows[0]["my_answer"] == "yes" and rows[1]["my_answer"] == "" and rows[2]["my_answer"] is None and rows[0]["debug_info"]["num_entities"] == 2


def test_search_strategies(spark, monkeypatch):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 12))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "idx long, embedding array<float>")
    q = v.where("idx < 20").withColumnRenamed("idx", "query_id")
    monkeypatch.setattr(vector, "QUERY_GROUP", 7)
    monkeypatch.setattr(vector, "VECTOR_BLOCK", 50)
    got = {(r["query_id"], r["rank"]): r["idx"] for r in vector.search(" Exact ", q, v, 5).collect()}
    s = x.astype(np.float32).astype(float) @ x[:20].astype(np.float32).astype(float).T
    assert all([got[i, r + 1] for r in range(5)] == np.argsort(-s[:, i])[:5].tolist() for i in range(20))
    ivf = {(r["query_id"], r["idx"]) for r in vector.search("ivf", q, v, 5, cells=16, probe=10).collect()}
    assert len({(i, x) for (i, _), x in got.items()} & ivf) >= 90
    with pytest.raises(ValueError):
        vector.search("other", q, v)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_the_registered_ivf_query_finds_all_neighbours(spark, sf):
    from graphloom.plans import registry

    want, got = ([tuple(r) for r in registry.queries()[name](spark, f"/root/testdata/{sf}").orderBy("query_id", "rank").collect()] for name in ("knn_exact", "knn_ivf"))
    assert got == want


@pytest.mark.parametrize("name", ["knn_entities", "hybrid_fusion", "hybrid_context"])
def test_entities_of_many_tied_places(spark, tmp_path, name):
    import duckdb

    from graphloom.plans import registry

    names = ["".join(chr(97 + (i * m + 5) % 26) for m in (7, 3, 11, 5, 9, 1, 17)).capitalize() for i in range(26)]
    tables = {"documents": [(i, f"{n} {names[(i + 9) % 26]} w{i}") for i, n in enumerate(names)], "benchmark": [(0, "w3 w4"), (1, "nothing here"), (2, f"{names[4]} w9")]}
    con = duckdb.connect()
    for t, rows in tables.items():
        spark.createDataFrame(rows, f"{'doc_id' if t == 'documents' else 'item_id'} long, text string").coalesce(1).write.parquet(f"{tmp_path}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    got = registry.queries()[name](spark, str(tmp_path))
    want = con.sql(registry.oracle_sql()[name])
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_embedding_model(spark):
    import numpy as np

    df = spark.createDataFrame([("ab",), (None,)], "t string")
    got = vector.embed(df, "t", lambda texts: np.array([[len(t), 3.0] for t in texts]), batch=1).collect()
    assert [pytest.approx(x["embedding"]) for x in got] == [[2 / 13**0.5, 3 / 13**0.5], [0.0, 1.0]]


def test_statistics(spark):
    c = spark.createDataFrame([(i, t) for i, t in enumerate([5, 399, 400, 1000, 1200, 1201])], "chunk_idx long, tokens int")
    assert [(r["low"], r["n"]) for r in stats.token_histogram(c).orderBy("low").collect()] == [(0, 2), (400, 1), (800, 0), (1000, 2)]
    assert tuple(stats.smallest_chunk(c).first()) == (0, 5)
    assert stats.token_quartiles(c).first()["q2"] == 700


def test_build_from_files(spark, tmp_path):
    src = tmp_path / "texts"
    src.mkdir()
    for i in range(3):
        (src / f"{i}_2001_TT_1.txt").write_text("BỘ X\n" + "\n".join(f"Điều {j}. Something Important Happened near Building {j} " + "từ " * 60 for j in range(1, 8)))
    config = cli.parse(["--dataset", str(src), "--output", str(tmp_path / "out"), "--min-tokens", "100", "--target-tokens", "150", "--max-tokens", "200", "--tail-merge", "50"])
    assert isinstance(config, BuildConfig)
    with pytest.raises(ValueError):
        run_build(spark, BuildConfig(dataset_dir=str(src), vector_backend="none"))
    t = run_build(spark, config)
    again = bm25.Index.load(spark, str(tmp_path / "out")).top_k(spark.createDataFrame([(1, "building 3")], "query_id long, query string"))
    assert again.count() > 0
    n = t["chunks"].count()
    assert n >= 6 and t["vectors"].where("collection = 'chunks'").count() == n
    assert t["edges"].count() > 0 and kg.known_edges(t["edges"], t["nodes"]).count() == t["edges"].count()
    meta = t["meta"].first()
    assert meta["counts"]["chunks"] == n and meta["config"]["max_chunk_tokens"] == "200"


def test_extraction_resumes(spark, tmp_path):
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    spark.range(0, 4).write.parquet(src)
    run = lambda: resume.process_available(spark, src, "id long", out, check, lambda df: df.withColumn("x", F.col("id") * 2))
    run()
    spark.range(4, 7).write.mode("append").parquet(src)
    run()
    run()
    assert sorted(r["x"] for r in resume.results(spark, out).collect()) == [0, 2, 4, 6, 8, 10, 12]
