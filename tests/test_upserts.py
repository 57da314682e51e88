"""Tables updated in part, hubs dealt over tasks, pages of the entity mapping, the subword counter."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph, kg
from graphloom.operators.upserts import Keyed


def test_an_upsert_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    t = Keyed(spark, str(tmp_path / "t"), "k", buckets=8)
    with pytest.raises(ValueError):
        t.read()
    rows = lambda: {tuple(r) for r in t.read().select("k", "v").collect()}
    t.upsert(spark.createDataFrame([(f"a{i}", i) for i in range(40)], "k string, v int"))
    before = {b: v for b, v in t._held(t.version()).items()}
    assert len(before) == 8 and len(rows()) == 40
    t.upsert(spark.createDataFrame([("a3", -3), ("new", 99), ("new", 5)], "k string, v int"))
    after = t._held(t.version())
    assert {b for b in after if after[b] != before[b]} == set(t.touched) and 1 <= len(t.touched) <= 2
    assert rows() == {(f"a{i}", i) for i in range(40)} - {("a3", 3)} | {("a3", -3), ("new", 99)}
    files = {p.parent.name for p in (tmp_path / "t" / "data" / "2").glob("bucket=*/*.parquet")}
    assert files == {f"bucket={b}" for b in t.touched}


def test_an_upsert_that_is_killed_leaves_the_old_state(spark, tmp_path, monkeypatch):
    t = Keyed(spark, str(tmp_path / "t"), "k", buckets=4)
    t.upsert(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"))

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # the data is written, the manifest is not
        m.setattr(type(spark), "createDataFrame", killed)
        new = spark.range(1).select(F.lit("a").alias("k"), F.lit(9).alias("v"))
        with pytest.raises(KeyboardInterrupt):
            t.upsert(new)
    assert t.version() == 1 and {tuple(r) for r in t.read().select("k", "v").collect()} == {("a", 1), ("b", 2)}
    (tmp_path / "t" / "manifest" / "2").mkdir()  # begun and not finished
    assert t.version() == 1
    t.upsert(new)
    assert {tuple(r) for r in t.read().select("k", "v").collect()} == {("a", 9), ("b", 2)}


def test_a_hub_is_dealt_over_tasks(spark, monkeypatch):
    edges = [("hub", f"x{i}") for i in range(600)] + [(f"x{i}", f"y{i}") for i in range(0, 600, 7)] + [("a", "hub"), ("b", "a")]
    e = spark.createDataFrame([(s, t, "r", "d", 0.5) for s, t in edges], "source string, target string, relation string, description string, weight double")
    n = spark.createDataFrame([(x,) for x in sorted({x for p in edges for x in p})], "name string")
    seeds = spark.createDataFrame([("a",), ("b",)], "name string")
    both = lambda: (
        {tuple(r) for r in graph.neighbors(e, seeds, 2, limit=9999).collect()}, {tuple(r) for r in graph.subgraph_edges(n, e, seeds, 2).collect()}, {tuple(r) for r in graph.reached(e, seeds, 3).collect()},
    )
    want = both()
    monkeypatch.setattr(graph, "HEAVY", 20)
    assert both() == want and len(want[0]) > 600
    monkeypatch.setattr(graph, "HEAVY", 50)
    step = graph.incident(e).select("at", "other").distinct()
    front = spark.createDataFrame([("s", "hub"), ("s", "x0"), ("t", "hub")], "seed string, here string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = graph._meet(front.hint("merge"), "here", step.hint("merge"), graph._parts(step))
        sizes = sorted(r["count"] for r in met.groupBy(F.spark_partition_id().alias("p")).count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2 * 601 + 2 and len(sizes) == 4 and sizes[-1] < 5 * sizes[len(sizes) // 2]


def test_no_page_of_the_mapping_is_larger_than_its_size(spark):
    rows = [("everywhere", i) for i in range(2500)] + [("twice", 3), ("twice", 2400), ("once", 7)]
    bridge = spark.createDataFrame(rows, "name string, chunk_idx long")
    pages = kg.entity_pages(bridge, 100).cache()
    assert pages.agg(F.max(F.size("chunks"))).first()[0] == 100
    assert sorted(map(tuple, pages.select("name", F.explode("chunks")).collect())) == sorted(rows)
    assert {tuple(r) for r in kg.page_directory(pages).collect()} == {("everywhere", 25, 0, 24, 2500), ("twice", 2, 0, 24, 2), ("once", 1, 0, 0, 1)}


def brute_tokens(word, pieces, low):
    """Over all segmentations: the most likely one, of equal ones the shortest."""
    best = None
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(word)]
        parts = [word[a:b] for a, b in zip(at, at[1:])]
        if all(p in pieces or len(p) == 1 for p in parts):
            score = math.fsum(max(pieces.get(p, -math.inf), low if len(p) == 1 else -math.inf) for p in parts)
            best = max(best or (-math.inf, 0), (round(score, 9), -len(parts)))
    return -best[1]


def test_subwords_equal_all_segmentations(spark):
    from graphloom.functions.subwords import UNKNOWN, SubwordCounter, n_subwords
    from graphloom.operators import chunking

    rng = random.Random(5)
    pieces = {"".join(rng.choice("▁abc") for _ in range(rng.randrange(1, 5))): -float(rng.randrange(1, 12)) for _ in range(40)}
    table = spark.createDataFrame(list(pieces.items()), "piece string, score double")
    count = SubwordCounter.of(table)
    low = min(pieces.values()) - UNKNOWN
    words = ["".join(rng.choice("abcx") for _ in range(rng.randrange(1, 9))) for _ in range(150)]
    assert [count(w) for w in words] == [brute_tokens("▁" + w, pieces, low) for w in words]
    assert count("") == count(" \n") == 0 and count("ab  c\n x") == count("ab") + count("c") + count("x")
    with pytest.raises(ValueError):
        SubwordCounter.of(table, most=5)
    df = spark.createDataFrame([("abc ab",), (None,)], "t string")
    assert [r[0] for r in df.select(n_subwords(F.col("t"), count)).collect()] == [count("abc ab"), 0]
    # budgets are counted by it
    text = " ".join(words)
    (row,) = chunking.flat_chunks(spark.createDataFrame([(text,)], "content string"), count=count, most=60).collect()
    assert len(row["pieces"]) > 3 and all(count(p) <= 60 for p in row["pieces"])
    assert " ".join(row["pieces"]).split() == words


def test_a_ranked_vocabulary_is_read_as_a_table(spark, tmp_path):
    import base64

    from graphloom.functions.subwords import SubwordCounter, vocabulary

    tokens = [b"a", b" a", b" ab", b"b", b"\xff", b" ", b"\n\n", "é".encode()]
    (tmp_path / "v.txt").write_text("\n".join(f"{base64.b64encode(t).decode()} {i}" for i, t in enumerate(tokens)))
    got = {r["piece"]: r["score"] for r in vocabulary(spark, str(tmp_path / "v.txt")).collect()}
    assert got == {p: pytest.approx(-math.log(i + 2)) for i, p in ((0, "a"), (1, "▁a"), (2, "▁ab"), (3, "b"), (5, "▁"), (7, "é"))}
    assert SubwordCounter(got)("ab é") == 3
