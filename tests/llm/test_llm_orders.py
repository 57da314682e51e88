"""The n-gram join under several orders against brute force."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from test_llm_similar import brute_components, corpus, documents

from graphloom.llm import near_dup, ngram_join


def joined(spark, rows, size=5):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(documents(spark, rows), size).collect()}


@pytest.mark.parametrize("size", [3, 5])
def test_join_equals_brute_force(spark, size):
    rows = corpus(seed=size, n=150)
    assert joined(spark, rows, size) == brute_components(rows, size, 80)


def near_copies(rng, n=70):
    """Chains of near copies at the edge of the threshold, a crowd, and a passage that all have."""
    base = [f"w{rng.randrange(900)}" for _ in range(60)]
    common = [f"c{i}" for i in range(30)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(900)}"
        rows.append((i, " ".join(words + common * (i % 3 == 0))))
    return rows + [(n + i, " ".join(common + [f"x{i}"] * (i % 4))) for i in range(20)] + [(500, None), (501, rows[3][1]), (502, "")]


def test_crowds_and_frequent_tokens_small_buckets(spark, monkeypatch):
    """Tokens that half of the documents have come last; many buckets, and several batches a task."""
    monkeypatch.setattr(ngram_join, "BUCKET", 300)
    monkeypatch.setattr(ngram_join, "FLUSH", 200)
    monkeypatch.setattr(ngram_join, "LEAST_OFTEN", 10)
    rows = near_copies(random.Random(2))
    assert joined(spark, rows) == brute_components(rows, 5, 80)


def test_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "GROUP_CLASSES", 20)
    monkeypatch.setattr(near_dup, "PIVOTS", 4)
    monkeypatch.setattr(near_dup, "SHARD", 16)
    rows = near_copies(random.Random(4), n=60)
    assert joined(spark, rows) == brute_components(rows, 5, 80)


def test_candidates_share_a_token_under_every_order():
    """Two sets alike under the first order only are not compared."""
    a, b = np.arange(0, 10, dtype=np.uint64), np.arange(0, 10, dtype=np.uint64)
    one, two = [np.array([1]), np.array([1])], [np.array([2]), np.array([3])]
    assert list(ngram_join.confirmed([a, b], [one, one, one], 80)) == [0, 0]
    assert len(set(ngram_join.confirmed([a, b], [one, two, one], 80))) == 2


def test_null_ids_empty_tables_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = ngram_join.join(documents(spark, [(None, text), (7, text), (7, text), (9, text + " x"), (None, None), (3, "\t ")])).collect()
    assert sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"]) for r in rows if r["n_shingles"]) == [(-1, 26, 7), (7, 26, 7), (7, 26, 7), (9, 27, 7)]
    assert sorted((r["doc_id"] or -1, r["component_id"]) for r in rows if not r["n_shingles"]) == [(-1, None), (3, 3)]
    assert ngram_join.join(documents(spark, [])).collect() == []


def test_tokens_dealt_at_once_fit_in_a_small_task():
    """Many distinct tokens go to their buckets in bounded memory."""
    rng = random.Random(1)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(5000)) for _ in range(420)]
    batches = [pa.record_batch([pa.array(texts[i : i + 60]), pa.array(range(i, i + 60)), pa.array(range(i, i + 60))], names=["text", "doc_id", "th"]) for i in range(0, 420, 60)]
    tracemalloc.start()
    for _ in ngram_join._deal(5, 4, np.empty(0, np.uint64))(iter(batches)):
        pass
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 130e6
