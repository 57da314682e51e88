"""Stored indexes, stored answers, retries, and questions to a build."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom import cli
from graphloom.config import BuildConfig
from graphloom.operators import bm25, retry, vector
from graphloom.operators.inverted_file import InvertedFile
from graphloom.operators.neighbor_graph import NeighborGraph
from graphloom.plans.ask import Retriever
from graphloom.plans.build import run_build, vector_index


def clustered(spark, clusters=20, each=60, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim)) * 4
    x = np.concatenate([c + rng.normal(size=(each, dim)) * 0.3 for c in centres])
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "idx long, embedding array<float>")


def rows(df):
    return {tuple(r) for r in df.select("query_id", "rank", "idx", "score").collect()}


def test_inverted_file_reads_only_the_partitions_it_may_need(spark, tmp_path):
    v = clustered(spark)
    q = v.where("idx < 120 and idx % 7 = 0").withColumnRenamed("idx", "query_id")  # of two clusters
    root = str(tmp_path / "ivf")
    InvertedFile.build(v, root, cells=20)
    again = InvertedFile.load(spark, root)
    again.FIRST = 2
    assert rows(again.search(q, 5)) == rows(vector.exact(q, v, 5))
    assert 0 < len(again.read) <= 8
    plan = again.partitions(again.read)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "cell" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert again.partitions(again.read[:1]).select(F.input_file_name()).distinct().count() < len(spark.read.parquet(f"{root}/cells").inputFiles()) / 2
    few = InvertedFile.load(spark, root, probe=1)
    assert few.search(q, 5).count() == q.count() * 5 and len(few.read) <= 4


def test_codes_keep_all_that_may_be_among_the_best(spark):
    """Vectors so near each other that their codes cannot tell them apart; nulls and empty tables."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=8) + rng.normal(size=(300, 8)) * 1e-4
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(900, None), (901, [])], "idx long, embedding array<float>")
    q = v.where("idx < 10").withColumnRenamed("idx", "query_id")
    assert rows(InvertedFile.build(v, cells=3).search(q, 7)) == rows(vector.exact(q, v, 7))
    for store in ("ivf", "graph", "exact"):
        assert vector.backend(store).build(v.where("idx = 900")).search(q, 3).count() == 0


def test_graph_finds_neighbours_in_clusters_and_is_reopened(spark, tmp_path):
    v = clustered(spark, clusters=12, each=100)
    q = v.where("idx % 40 = 0").withColumnRenamed("idx", "query_id")
    root = str(tmp_path / "graph")
    NeighborGraph.build(v, root)
    g = NeighborGraph.load(spark, root, beam=32)
    found, want = rows(g.search(q, 5)), rows(vector.exact(q, v, 5))
    assert len(found & want) >= 0.9 * len(want)
    assert g.work["scored"] < 0.5 * q.count() * v.count() and g.work["rounds"] > 1
    near = spark.read.parquet(f"{root}/nodes").agg(F.max(F.size("near")), F.count("*")).first()
    assert near[0] <= 32 and near[1] == 1200


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_of_the_registered_graph_query(spark, sf):
    from graphloom.plans import registry

    want, got = ({(r["query_id"], r["idx"]) for r in registry.queries()[name](spark, f"/root/testdata/{sf}").collect()} for name in ("knn_exact", "knn_graph"))
    assert len(want & got) >= 0.9 * len(want)


def test_complete_graph_search_misses_no_neighbour_and_skips_cells(spark, tmp_path):
    """In a graph of few links a walk misses neighbours, which the completion finds; on clusters it reads a few cells."""
    x = np.random.default_rng(5).normal(size=(1200, 32))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "idx long, embedding array<float>")
    q = v.where("idx % 40 = 0").withColumnRenamed("idx", "query_id")
    NeighborGraph.build(v, str(tmp_path / "spread"), degree=1, cells=3)
    how = {"beam": 1, "width": 1, "starts": 1}
    want = rows(vector.exact(q, v, 5))
    assert len(rows(NeighborGraph.load(spark, str(tmp_path / "spread"), **how).search(q, 5)) & want) < len(want)
    assert rows(NeighborGraph.load(spark, str(tmp_path / "spread"), complete=True, **how).search(q, 5)) == want
    v = clustered(spark, clusters=12, each=50)
    q = v.where("idx = 0").withColumnRenamed("idx", "query_id")
    g = NeighborGraph.build(v, str(tmp_path / "clusters"), complete=True)
    assert rows(g.search(q, 5)) == rows(vector.exact(q, v, 5))
    assert g.work["completed"] < len(g.entries)


def test_exact_search_by_tasks_and_by_blocks_agree(spark, monkeypatch):
    v = clustered(spark, clusters=3, each=40).unionByName(clustered(spark, clusters=3, each=40).withColumn("idx", F.col("idx") + 1000)).repartition(3)
    q = v.where("idx % 9 = 0").withColumnRenamed("idx", "query_id")
    one = rows(vector.exact(q, v, 4))
    monkeypatch.setattr(vector, "QUERY_GROUP", 5)
    assert rows(vector.exact(q, v, 4)) == one


def test_bm25_skips_blocks_by_their_bounds_and_terms_not_asked_for(spark, tmp_path):
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(f"w{j}" for j in rng.integers(0, 60, 30)) + (" rare rare rare topic" if i % 500 < 4 else "")) for i in range(2000)]
    chunks = spark.createDataFrame(texts + [(2000, ""), (2001, None)], "chunk_idx long, content string")
    root = str(tmp_path / "bm25")
    index = bm25.Index(chunks, root, zone_bits=4)
    q = spark.createDataFrame([(0, "rare topic w3"), (1, "absent"), (2, "rare w7 w7"), (3, None)], "query_id long, query string")
    got = sorted(map(tuple, index.top_k(q, 3).collect()))
    assert index.work["scored"] < 0.6 * index.work["zones"]
    # all zones scored, by plain Python
    n, docs = 2002, [(i, (t or "").split()) for i, t in texts]
    mean = sum(len(d) for _, d in docs) / n
    df = {}
    for _, d in docs:
        for w in set(d):
            df[w] = df.get(w, 0) + 1
    raw = {w: np.log(n - c + 0.5) - np.log(c + 0.5) for w, c in df.items()}
    low = 0.25 * sum(raw.values()) / len(raw)
    want = []
    for query_id, text in ((0, "rare topic w3"), (2, "rare w7 w7")):
        score = {i: round(sum((raw[w] if raw[w] >= 0 else low) * d.count(w) * 2.5 / (d.count(w) + 1.5 * (0.25 + 0.75 * len(d) / mean)) for w in text.split()), 6) for i, d in docs}
        want += [(query_id, r + 1, i, pytest.approx(score[i], abs=2e-6)) for r, i in enumerate(sorted((i for i in score if score[i] > 0), key=lambda i: (-score[i], i))[:3])]
    assert got == want
    again = bm25.Index.load(spark, root)
    assert sorted(map(tuple, again.top_k(q, 3).collect())) == got
    asked = spark.createDataFrame([(0, "rare", 1)], "query_id long, term string, times int")
    plan = again._of(asked)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "EqualTo(term,rare)" in plan.replace("In(term, [rare])", "EqualTo(term,rare)")


def test_bm25_postings_shuffle_nothing_and_one_pass_equals_the_index(spark, monkeypatch):
    texts = [(i, " ".join(f"w{(i * j * 7) % 211}" for j in range(i % 40))) for i in range(300)] + [(300, None), (301, "..."), (302, "w1 W1 w1, w0")]
    chunks = spark.createDataFrame(texts, "chunk_idx long, content string")
    posts = bm25.postings(chunks)
    assert "Exchange" not in posts._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, posts.where("chunk_idx >= 300").collect())) == [(302, 4, "w0", 1), (302, 4, "w1", 3)]
    assert posts.agg(F.sum("tf")).first()[0] == sum(len((t or "").replace(".", " ").split()) for _, t in texts)
    q = spark.createDataFrame([(0, "w3 w4 w4"), (1, "absent"), (2, "w1"), (3, None)], "query_id long, query string")
    one = sorted(map(tuple, bm25.top_k(chunks, q, 4).collect()))
    monkeypatch.setattr(bm25, "SENT", 0)
    assert one and sorted(map(tuple, bm25.top_k(chunks, q, 4).collect())) == one


def model_in(folder):
    class Model:
        """Names the capitalised words of a text; a file in the folder for each call."""

        def entities(self, text):
            with open(os.path.join(folder, os.urandom(8).hex()), "w") as f:
                f.write(text)
            if "Unanswerable" in text:
                raise ValueError
            return json.dumps([{"name": w, "type": "T"} for w in dict.fromkeys(text.split()) if w[:1].isupper()][:6])

        def relations(self, text, entities):
            return json.dumps([{"source": a["name"], "target": b["name"], "relation": "r"} for a, b in zip(entities, entities[1:])])

    return Model


def texts_in(src, n, word="Something"):
    for i in range(n):
        (src / f"{i}_2001_TT_1.txt").write_text(f"BỘ X\nĐiều 1. {word} Important Happened {i} " + "từ " * 90)


def test_a_changed_corpus_asks_for_what_changed_and_nothing_else(spark, tmp_path):
    src, calls = tmp_path / "texts", tmp_path / "calls"
    src.mkdir()
    calls.mkdir()
    texts_in(src, 5)
    how = {"dataset_dir": str(src), "output_dir": str(tmp_path / "out"), "work_dir": str(tmp_path / "work"), "kg_backend": "gpt", "batch_size": 2, "max_workers": 2, "keyword_top_k": 0}
    make, asked = model_in(str(calls)), lambda: len(list(calls.iterdir()))
    t = run_build(spark, BuildConfig(**how), make)
    assert t["chunks"].count() == asked() == 5
    run_build(spark, BuildConfig(**how), make)
    assert asked() == 5
    (src / "1_2001_TT_1.txt").write_text("BỘ X\nĐiều 1. Another Text Stands here " + "từ " * 90)
    (src / "9_2001_TT_1.txt").write_text("BỘ X\nĐiều 1. Added Later " + "chữ " * 90)
    t = run_build(spark, BuildConfig(**how), make)
    assert asked() == 7 and t["chunks"].count() == 6
    names = {r["name"] for r in t["nodes"].collect()}
    assert {"ANOTHER", "ADDED"} <= names
    assert t["chunks"].where("content like '%Happened 1 %'").isEmpty()
    run_build(spark, BuildConfig(**how | {"keyword_top_k": 3}), make)  # a setting that changes what is asked
    assert asked() == 13
    run_build(spark, BuildConfig(**how | {"kg_model": "other"}), make)
    assert asked() == 19
    t = run_build(spark, BuildConfig(**how | {"min_chunk_tokens": 10, "target_chunk_tokens": 20, "max_chunk_tokens": 30, "tail_merge_threshold": 5}), make)
    assert t["chunks"].count() > 12 and t["meta"].first()["mode"] == "extractor"
    assert t["meta"].first()["counts"]["passages"] == 6 and t["meta"].first()["counts"]["entities"] == t["entities_raw"].count()


def test_calls_that_fail_are_asked_for_again(spark, tmp_path):
    from graphloom.operators import answers

    calls = tmp_path / "calls"
    calls.mkdir()
    chunks = spark.createDataFrame([(0, "Good Text", None), (1, "Unanswerable", ["A", "B"]), (2, "Good Text", None)], "chunk_idx long, content string, keywords array<string>")
    go = lambda: answers.ask(chunks, str(tmp_path / "work"), model_in(str(calls)), "m", 100, 2, 10, attempts=1, wait=0.0)
    one = {r["chunk_idx"]: r["entities_json"] for r in go().collect()}
    assert one[0] == one[2] != "" and one[1] == "" and len(list(calls.iterdir())) == 2  # equal texts are asked for once
    go()
    assert len(list(calls.iterdir())) == 3


class RateLimitError(Exception):
    pass


def driven(policy, errors, tmp_path, shared=True):
    """Waits of a call that meets these errors before it is answered."""
    now, slept = [1000.0], []

    def sleep(s):
        slept.append(round(s, 3))
        now[0] += s

    caller = retry.Caller(policy, retry.SharedWait("t", str(tmp_path)) if shared else None, lambda: now[0], sleep)
    left = list(errors)

    def what():
        if left:
            raise left.pop(0)
        return "yes"

    return caller.call(what), slept


def test_waits_by_kind_of_error(tmp_path):
    nim, gpt = retry.POLICIES["nim"], retry.POLICIES["gpt"]
    assert driven(nim, [RateLimitError()] * 4, tmp_path / "none", False) == ("yes", [1.0, 2.0, 4.0, 8.0])
    for name in "abcd":
        (tmp_path / name).mkdir()
    assert driven(nim, [RateLimitError()] * 3, tmp_path / "a") == ("yes", [1.0, 2.0, 4.0])
    assert driven(nim, [TimeoutError(), ConnectionError(), TimeoutError()], tmp_path / "b") == ("yes", [1.0, 2.0, 4.0])
    assert driven(nim, [ValueError()] * 3, tmp_path / "b") == ("yes", [1.0, 1.0, 1.0])
    assert driven(nim, [ValueError()] * 9, tmp_path / "b") == ("", [1.0] * 4)
    answer, slept = driven(gpt, [ValueError(), TimeoutError()], tmp_path / "c")
    assert answer == "yes" and sum(slept) >= 3 and retry.SharedWait("t", str(tmp_path / "c")).until() > 1000
    # a wait that one caller sets holds the others
    retry.SharedWait("t", str(tmp_path / "d")).hold(1007.0)
    retry.SharedWait("t", str(tmp_path / "d")).hold(1003.0)
    assert driven(nim, [], tmp_path / "d") == ("yes", [7.0])
    assert [retry.kind_of(e) for e in (RateLimitError(), TimeoutError(), OSError(), type("E", (Exception,), {"status_code": 429})())] == ["held", "slow", "failed", "held"]
    assert retry.Policy(held_most=30).waits("held", 0, 9) == (0.0, 30.0)


@pytest.mark.parametrize("backend", ["exact", "ivf", "graph"])
def test_questions_to_a_build(spark, tmp_path, backend):
    src, out = tmp_path / "texts", str(tmp_path / "out")
    src.mkdir()
    for i, word in enumerate(["Taxation", "Forestry", "Railways", "Fisheries"]):
        (src / f"{i}_2001_TT_1.txt").write_text("BỘ X\n" + "\n".join(f"Điều {j}. {word} Authority Collects {word.lower()} fee {j} " + "từ " * 60 for j in range(1, 5)))
    config = cli.parse(["-d", str(src), "-o", out, "-b", backend, "--min-tokens", "40", "--target-tokens", "60", "--max-tokens", "80", "--tail-merge", "10"])
    run_build(spark, config)
    assert vector_index(spark, out, backend, "chunks").search(spark.createDataFrame([(0, [1.0] * 64)], "query_id long, embedding array<double>"), 2).count() == 2
    with pytest.raises(KeyError):
        vector_index(spark, out, "exact" if backend != "exact" else "ivf", "chunks")
    q = spark.createDataFrame([(0, "forestry fee", None), (1, "railways fee 3", "A case")], "query_id long, query string, case string")
    r = Retriever(spark, out, backend)
    found = {x["query_id"]: x for x in r.contexts(q).collect()}
    assert "Forestry" in found[0]["context"] and found[1]["num_chunks"] == 6 and found[1]["num_entities"] > 0
    said = {x["query_id"]: x["my_answer"] for x in r.answers(q, lambda: lambda prompt: "case" if "A case" in prompt else "none").collect()}
    assert said == {0: "none", 1: "case"}


def test_command_line(spark, tmp_path):
    a = cli.parser().parse_args(["--extractor", "tests.test_stores:Model", "--kg-backend", "nim", "--max-workers", "3", "-m", "json:dumps"])
    c = cli.configured(a)
    assert (c.kg_backend, c.max_workers) == ("nim", 3) and cli.named(a.model) is json.dumps and cli.named(None) is None
    assert cli.parse(["--extractor", "x:y"]).kg_backend == "gpt" and cli.parse([]).kg_backend == "rules"
    src, out = tmp_path / "texts", tmp_path / "out"
    src.mkdir()
    texts_in(src, 3)
    (tmp_path / "q.json").write_text(json.dumps([{"type": "t", "query": "Something", "expected_answer": "e"}]))
    cli.main(["-d", str(src), "-o", str(out), "-b", "ivf"])
    cli.main(["-o", str(out), "-b", "ivf", "--ask", str(tmp_path / "q.json")])
    (row,) = spark.read.json(f"{out}/asked").collect()
    assert "Something" in row["prompt"] and row["num_chunks"] == 3


def test_pretty_json_array(spark, tmp_path):
    from graphloom.sources import artifacts

    for n in (0, 1, 25):
        df = spark.range(n).select((F.col("id") * 7 % 25).alias("id"), F.concat(F.lit("chữ "), F.col("id").cast("string")).alias("t"), F.lit(None).cast("string").alias("x"))
        artifacts.save_json_array(df, str(tmp_path / f"j{n}"), "id")
        text = "".join(p.read_text() for p in sorted((tmp_path / f"j{n}").glob("part-*")))
        got = json.loads(text)
        assert [r["id"] for r in got] == sorted(r["id"] for r in df.collect()) and all(r["x"] is None and "chữ" in r["t"] for r in got)
        assert n == 0 or "\n" in text
