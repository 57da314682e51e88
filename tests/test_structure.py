"""Parsing, packing and chunk building."""

import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import chunking, structure


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, content string")


def test_units_of_a_nested_text(spark):
    text = "Lời nói đầu\nChương I\nĐiều 1. x\n1. y\na) z\nChương II\nĐiều 2. w"
    rows = structure.units(docs(spark, text), ["doc_id"]).orderBy("unit_no").collect()
    assert [(r["level"], r["hierarchy_path"]) for r in rows] == [
        ("", ""), ("chuong", "Chương I"), ("dieu", "Chương I > Điều 1"), ("khoan", "Chương I > Điều 1 > Khoản 1"), ("diem", "Chương I > Điều 1 > Khoản 1 > Điểm a"),
        ("chuong", "Chương II"), ("dieu", "Chương II > Điều 2"),
    ]


def test_units_keep_all_words(spark):
    text = "\n".join(["Điều 1. a b", "", "c", "  ", "2. d", "e"])
    rows = structure.units(docs(spark, text), ["doc_id"]).orderBy("unit_no").collect()
    assert " ".join(r["content"] for r in rows).split() == text.split()


@pytest.mark.parametrize("n,merged", [(5, False), (6, True)])
def test_short_runs(spark, n, merged):
    text = "\n\n".join(["a long enough first paragraph", *[f"a) {i}" for i in range(n)], "a long enough last paragraph"])
    got = structure.clean_paragraphs(docs(spark, text), ["doc_id"]).first()["content"]
    assert (len(got.split("\n\n")) == 3) == merged and got.split() == text.split()


def paragraphs_by_loop(text):
    import re

    made, runs = [], []
    for p in re.split(r"\n{2,}", text):
        lines = [x.strip() for x in p.split("\n") if x.strip()]
        p = " ".join(lines) if len(lines) >= 6 and sum(len(x) <= 12 for x in lines) >= 0.6 * len(lines) else p
        short = 1 <= len(p.strip()) <= 15
        runs.append([p]) if not (short and runs and made[-1]) else runs[-1].append(p)
        made.append(short)
    return "\n\n".join(" ".join(p.strip() for p in r) if len(r) >= 6 else "\n\n".join(r) for r in runs)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", range(3))
def test_paragraphs_are_cleaned_in_their_rows(spark, seed):
    rng = random.Random(seed)
    kinds = ["a", " b\u3000", "", " ", "a paragraph that is long enough", "x" * 15, "x" * 16, "\n".join("abcdef"), "\n".join(["abc"] * 4 + ["a line of more letters"] * 3)]
    texts = ["\n\n".join(rng.choices(kinds, [6, 2, 1, 1, 1, 2, 1, 1, 1], k=rng.choice([1, 5, 40, 300]))) for _ in range(30)] + ["", "\n\n", "a " * 3]
    cleaned = structure.clean_paragraphs(docs(spark, *texts, None), ["doc_id"]).where(F.length("content") >= 0)
    assert "Exchange" not in plan(cleaned) and "Window" not in plan(cleaned)
    assert {r["doc_id"]: r["content"] for r in cleaned.collect()} == {i: paragraphs_by_loop(t) for i, t in enumerate(texts)}


def test_a_long_text_of_short_runs_is_cleaned_in_linear_time(spark):
    import time

    text = "\n\n".join(["a", "b", "a paragraph that is long enough"] * 100_000)
    began = time.time()
    assert structure.clean_paragraphs(docs(spark, text), ["doc_id"]).where(F.length("content") > 0).first()["content"] == text
    assert time.time() - began < 60


def test_parsing_shuffles_nothing(spark):
    d = docs(spark, "Điều 1. a\n1. b", None)
    for df in (structure.units(d, ["doc_id"]).where("level <> ''"), structure.passages(d, ["doc_id"]).where(F.length("content") > 0), structure.unit_arrays(d, ["doc_id"]).where(F.size("u") > 0)):
        assert "Exchange" not in plan(df) and "Window" not in plan(df)


def test_a_long_text_of_many_headings_is_parsed_in_linear_time(spark):
    import time

    n = 40_000
    text = "\n".join(["Chương I"] + [f"Điều {i}. a\nb" for i in range(n)])
    began = time.time()
    rows = structure.units(docs(spark, text), ["doc_id"]).where(F.length("content") > 0).orderBy("unit_no").collect()
    assert time.time() - began < 60
    assert [(r["unit_no"], r["hierarchy_path"], r["content"]) for r in rows[1:]] == [(i + 2, f"Chương I > Điều {i}", f"Điều {i}. a\nb") for i in range(n)]


def test_passages(spark):
    long = "Điều 9. " + "x" * 10_050
    text = "\n".join([f"Điều {i}. " + "y" * 4000 for i in range(5)] + [long, "Điều 10. z"])
    p = structure.passages(docs(spark, text, "short", "w " * 60), ["doc_id"]).orderBy("doc_id", "passage_no").collect()
    assert [(r["doc_id"], r["passage_no"]) for r in p] == [(0, 1), (0, 2), (0, 3), (0, 4), (2, 1)]
    assert p[3]["content"] == long


@pytest.mark.parametrize("seed", range(4))
def test_greedy_groups_against_a_loop(spark, seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 5, 30, 60, 120]) for _ in range(40)]
    groups, used = [[]], 0
    for n in lengths:
        if n > 100:
            groups += [[n], []]
            used = 0
        elif used + n > 100:
            groups.append([n])
            used = n
        else:
            groups[-1].append(n)
            used += n
    want = [i for i, g in enumerate(g for g in groups if g) for _ in g]
    df = spark.createDataFrame([(lengths,)], "n array<int>")
    assert df.select(F.expr(structure.greedy_groups("n", 100)).alias("g")).first()["g"] == want


def unit(n, i=0):
    return {"unit_no": i, "level": "dieu", "marker": f"Điều {i}", "content": " ".join([f"w{i}"] * n), "hierarchy_path": f"Điều {i}"}


@pytest.mark.parametrize(
    "sizes,tokens",
    [([500, 600, 300], [1400]), ([700, 700], [850, 550]), ([1000, 1000, 300], [1000, 1300]), ([1000, 1000, 150], [1000, 1150]), ([], []), ([100], [100])],
)
def test_blocks(sizes, tokens):
    got = chunking.blocks([unit(n, i) for i, n in enumerate(sizes)], chunking.count_words)
    assert [b["tokens"] for b in got] == tokens and sum(tokens) == sum(sizes)


def test_oversized_units_are_cut():
    got = chunking.blocks([unit(1500)], chunking.count_words)
    assert sum(b["tokens"] for b in got) == 1500 and max(b["tokens"] for b in got[:-1] or got) <= 1600
    pieces = chunking.pack_text("\n\n".join(" ".join(["v"] * 400) for _ in range(6)), chunking.count_words, 1000)
    assert [chunking.count_words(p) for p in pieces] == [800, 800, 800]


def test_word_packing_counts_one_more_a_word():
    pieces = chunking._greedy(["a"] * 10, lambda _: 1, 4, " ", 1)
    assert [len(p.split()) for p in pieces] == [2, 2, 2, 2, 2] or [len(p.split()) for p in pieces][0] == 2


@pytest.mark.parametrize(
    "text,n",
    [("Điều 1 a\nĐiều 2 b", 2), ("a\n\nb", 2), ("a.\nb", 2), ("a. B", 2), ("abc", 1)],
)
def test_sentences(text, n):
    assert len(chunking.sentences(text)) == n


def test_split_at():
    first, rest = chunking.split_at("a b c d. E f g", chunking.count_words, 4)
    assert (first, rest) == ("a b c d.", "E f g")
    assert chunking.split_at("a b", chunking.count_words, 5) == ("a b", "")
    first, rest = chunking.split_at("a b c d", chunking.count_words, 4)
    assert (first, rest) == ("a b c d", "")


def test_unique_ids(spark):
    rows = [("x", 1), ("x", 2), ("x_1", 3), ("y", 4), ("x", 5), ("x_1", 6)]
    out = [r["id"] for r in chunking.unique_ids(spark.createDataFrame(rows, "b string, n long"), "b", "n").collect()]
    assert len(set(out)) == 6


def ids_by_loop(rows):
    seen, out = set(), {}
    for base, n in sorted(rows, key=lambda r: r[1]):
        made, i = base, 0
        while made in seen:
            i += 1
            made = f"{base}_{i}"
        seen.add(made)
        out[n] = made
    return out


@pytest.mark.parametrize("kind", ["few", "all", "random"])
def test_unique_ids_of_nested_markers_against_a_loop(spark, kind):
    from itertools import product

    rng = random.Random(5)
    if kind == "few":
        bases = ["d_1_1", "d_1_1_1", "d_1_1_1_1"] * 2
    elif kind == "all":
        bases = ["_".join(("d", *m)) for size in (2, 3, 4) for m in product("123", repeat=size)] * 4
    else:
        bases = ["_".join(("d", *rng.choices(["1", "2", "01", "3"], k=rng.choice([1, 2, 2, 3, 4, 5])))) for _ in range(600)]
    rng.shuffle(bases)
    rows = [(b, i) for i, b in enumerate(bases)]
    got = {r["n"]: r["id"] for r in chunking.unique_ids(spark.createDataFrame(rows, "b string, n long"), "b", "n").collect()}
    assert got == ids_by_loop(rows) and len(set(got.values())) == len(rows)


def test_ids_of_all_units_against_a_loop(spark, tmp_path):
    from graphloom.functions import text
    from graphloom.plans import base, registry

    texts = ["\n".join(["x"] * 5 + [m] + ["x"] * 5 + [n]) for m, n in (("1.2.1 y", "1.2 y"), ("1.2 y", "1.2.1.1 y"), ("1.2.1 y", "1.2.2 y"))]
    spark.createDataFrame([(i, texts[i % 3]) for i in range(30)], "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    units = structure.units(base.legal(spark, str(tmp_path)), ["doc_id"])
    bases = units.select(text.range_id((F.col("doc_id") % 5).cast("string"), F.col("marker"), F.col("marker")), F.struct("doc_id", "unit_no"))
    got = {(r["doc_id"], r["unit_no"]): r["id"] for r in registry.queries()["chunk_ids_all"](spark, str(tmp_path)).collect()}
    assert got == ids_by_loop([tuple(r) for r in bases.collect()])


def test_flat_chunks_are_named_by_their_place(spark):
    flat = "\n\n".join("đoạn văn " * 300 for _ in range(5))
    rows = [("d", "p/2", 1, "3/4", flat), ("d", "p/3", 1, "3/4", flat)]
    chunks = chunking.build_chunks(spark.createDataFrame(rows, "doc_id string, path string, passage_no int, doc_number string, content string")).orderBy("chunk_idx").collect()
    n = len(chunks) // 2
    assert n > 1 and [r["id"] for r in chunks] == [f"chunk_3_4_para_{i}{x}" for x in ("", "_1") for i in range(n)]


def test_build_chunks(spark):
    legal = "Mở đầu\n" + "\n".join(f"Điều {i}. " + f"nội dung {i} " * 300 for i in range(1, 6))
    flat = "\n\n".join("đoạn văn " * 300 for _ in range(5))
    rows = [("d1", "p/1", 1, "1/2", legal), ("d2", "p/2", 1, "3/4", flat), ("d3", "p/3", 1, "5", "quá ngắn"), ("d1", "p/1", 2, "1/2", legal)]
    chunks = chunking.build_chunks(spark.createDataFrame(rows, "doc_id string, path string, passage_no int, doc_number string, content string")).orderBy("chunk_idx").collect()
    assert [r["chunk_idx"] for r in chunks] == list(range(len(chunks))) and len({r["id"] for r in chunks}) == len(chunks)
    assert {r["semantic_level"] for r in chunks if r["doc_id"] == "d2"} == {"paragraph"} and not [r for r in chunks if r["doc_id"] == "d3"]
    assert all(r["tokens"] <= 1600 for r in chunks)
    assert [r["path"] for r in chunks] == sorted(r["path"] for r in chunks)


def test_packing_holds_a_few_rows_of_a_batch_at_once():
    """A batch of many rows comes out in small ones, with every row and in order."""
    import pyarrow as pa

    class Rows:
        class schema:
            fields = ()

        def mapInArrow(self, run, kind):
            return run

    run = chunking.flat_chunks(Rows(), "t")
    texts = [f"w{i} " * (i % 7) for i in range(1000)]
    out = list(run(iter([pa.record_batch([pa.array(texts)], names=["t"])])))
    assert max(b.num_rows for b in out) <= 256
    assert [p for b in out for p in b.column("pieces").to_pylist()] == [[t] for t in texts]
