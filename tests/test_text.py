"""Text functions, markers and the loader on fixtures that the tables do not hold."""

import pytest
from pyspark.sql import functions as F

from graphloom.functions import markers, text as T
from graphloom.sources import artifacts, corpus


def one(spark, f, value):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("raw,want", [(None, ""), (" a \t b\r\n\n\n\nc ", "a b\n\nc"), ("  x  ", "x")])
def test_normalize(spark, raw, want):
    assert one(spark, T.normalize_text, raw) == want


def test_clean(spark):
    assert one(spark, T.clean_text, "a  \r\n \r\n  b\n***\nc\n**\n") == "a\n\nb\nc"


@pytest.mark.parametrize("raw,want", [("Điều 5 – Khoản Đ", "dieu_5_khoan_d"), ("", ""), ("Ấp Ổ--ữ", "ap_o_u")])
def test_slug(spark, raw, want):
    assert one(spark, T.slugify, raw) == want


def test_metadata(spark):
    assert one(spark, T.doc_number, "38_2001_PL_1") == "38/2001/PL"
    assert one(spark, T.issuing_body, "********\nCỘNG HÒA\nĐộc lập - Tự do\n\nBỘ A\nx") == "BỘ A"
    assert one(spark, T.issuing_body, "\n" * 12 + "late") == ""


def test_range_ids(spark):
    df = spark.createDataFrame([("1/2", "Điều 1", "Điều 3"), ("1/2", "Điều 1", "Điều 1"), ("", "", "")], "n string, a string, b string")
    assert [r[0] for r in df.select(T.range_id(F.col("n"), F.col("a"), F.col("b"))).collect()] == ["chunk_1_2_dieu_1_to_dieu_3", "chunk_1_2_dieu_1", "chunk_unknown_root"]


@pytest.mark.parametrize(
    "line,want",
    [
        ("PHỤ LỤC 2: biểu mức", ("phu_luc", "PHỤ LỤC 2: biểu mức")), ("Phần II", ("phan", "Phần II")), ("phần mềm", ("phan", "Phần m")), ("mục chi phí", ("muc", "Mục c")),
        ("Chương 3", ("chuong", "Chương 3")), ("Điều 5. x", ("dieu", "Điều 5")), ("điều 5", ("", "")), ("KHOẢN 2", ("khoan", "Khoản 2")), ("1.2 x", ("sub_item", "1.2")),
        ("12. x", ("khoan", "Khoản 12")), ("12.", ("", "")), ("500.000 đồng", ("sub_item", "500.000")), ("a) x", ("diem", "Điểm a")), ("đ. x", ("diem", "Điểm đ")), ("x", ("", "")),
    ],
)
def test_markers(spark, line, want):
    assert tuple(one(spark, markers.classify, f"  {line} ")) == want


def test_any_marker(spark):
    assert [one(spark, markers.has_markers, x) for x in ("x\n Điều 1", "Phụ lục 1", "plain", None, "x\n1. y")] == [True, False, False, False, True]


def test_broken_tables(spark):
    table = "\n".join(["12,5"] * 6 + ["a longer line of words"] * 4)
    assert one(spark, T.is_corrupted_block, table) and not one(spark, T.is_corrupted_block, "a\nb")
    assert one(spark, T.collapse_block, " a \n\n b") == "a b"


@pytest.mark.parametrize(
    "answer,n",
    [('```json\n[{"name": "A"}, 7, {"name": "B"}]\n```', 2), ("{}", 0), ("[{'name': 'x'}]", 0), ("", 0), (None, 0), ('[{"a": 1}] x]', 0), ("[]", 0), ("[1, [2]]", 0)],
)
def test_json_arrays(spark, answer, n):
    assert len(one(spark, T.json_objects, answer)) == n


@pytest.mark.parametrize("raw,want", [("x", 0.5), (None, 0.5), ("0", 0.1), ("5", 1.0), ("0.7", 0.7), ("NaN", 1.0)])
def test_weights(spark, raw, want):
    assert one(spark, T.weight, raw) == want


def test_tokens(spark):
    assert one(spark, T.tokenize, "Điều 1: (a-b) C_d!") == ["điều", "1", "a", "b", "c", "d"]
    assert one(spark, T.tokenize, None) == []


def test_questions(spark, tmp_path):
    (tmp_path / "q.json").write_text('[{"type": "f", "query": "q1", "expected_answer": "a"}, {"type": "c", "query": "q2", "expected_answer": "b", "case": "t"}]')
    rows = {r["query"]: r["question"] for r in corpus.load_questions(spark, str(tmp_path / "q.json")).collect()}
    assert rows == {"q1": "q1", "q2": "[Tình huống thực tế]: t\n[Câu hỏi]: q2"}
    assert [(r["query_id"], r["query"]) for r in corpus.load_questions(spark, str(tmp_path / "q.json")).orderBy("query_id").collect()] == [(1, "q1"), (2, "q2")]


def test_merged_report(spark, tmp_path):
    reports = spark.createDataFrame([(f"d{i}", f"# d{i}\n\ntext") for i in (3, 1, 2)], "doc_id string, markdown string")
    artifacts.save_reports(reports, str(tmp_path / "merged"))
    parts = sorted((tmp_path / "merged").glob("part-*"))
    assert "".join(p.read_text() for p in parts) == "".join(f"# d{i}\n\ntext\n\n---\n\n" for i in (1, 2, 3))


def test_loader(spark, tmp_path):
    body = "BỘ A\n" + "nội dung " * 10
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/38_2001_PL_1.txt").write_bytes(b"\xef\xbb\xbf" + body.replace("\n", "\r\n").encode())
    (tmp_path / "latin.txt").write_bytes(("caf\xe9 " * 20).encode("latin-1"))
    (tmp_path / "short.txt").write_text("x")
    (tmp_path / "other.md").write_text("y" * 100)
    docs = {r["doc_id"]: r for r in corpus.load_documents(spark, str(tmp_path)).collect()}
    assert set(docs) == {"38_2001_PL_1", "latin"}
    d = docs["38_2001_PL_1"]
    assert d["path"] == "DATASET::sub/38_2001_PL_1.txt" and d["content"] == body.strip() and d["doc_number"] == "38/2001/PL" and d["issuing_body"] == "BỘ A"
    assert docs["latin"]["content"].startswith("café")


def test_artifacts(spark, tmp_path):
    v = spark.createDataFrame([("chunks", 0, [1.0]), ("entities", 0, [2.0]), ("entities", 1, [2.0])], "collection string, idx long, embedding array<float>")
    artifacts.save_vectors(v, str(tmp_path))
    assert artifacts.load_collection(spark, str(tmp_path), "entities").count() == 2
    assert {r["collection"]: r["n"] for r in artifacts.collection_sizes(artifacts.load(spark, str(tmp_path), "vectors")).collect()} == {"chunks": 1, "entities": 2}
    assert artifacts.exists(spark, str(tmp_path), "vectors") and not artifacts.exists(spark, str(tmp_path), "nodes")
    with pytest.raises(KeyError):
        artifacts.load_collection(spark, str(tmp_path), "none")
