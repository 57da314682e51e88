"""The driver's contract."""

import re

import __spark_entry__ as entry


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_queries_and_sql_agree_by_name():
    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(entry.queries()) > 45


def test_columns_match_the_sql(spark):
    """Each query's columns are the SQL's, at the smallest size."""
    import os

    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in sorted({m[1] for m in re.finditer(r"(\w+)\.parquet", " ".join(os.listdir(d)))}):
        p = f"{d}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    queries = entry.queries()
    for name in ("normalize_text", "legal_units", "entity_merge", "bm25_topk", "graph_stats"):
        got, want = queries[name](spark, d), con.sql(entry.oracle_sql()[name])
        assert sorted(got.columns) == sorted(want.columns) and got.count() == len(want.fetchall())
