"""Mixing, sharding, line dedup and packing: laws, ties, nulls, empty tables, clashing columns."""

import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from graphloom.llm import line_dedup, mixing, packing, sharding

ROWS = "doc_id long, text string, lang string, source string, n_chars long, k string, size long, h string, n long, u string, target double"


def spark_hash(*values, seed=42):
    """Spark's xxhash64 of longs, (value, "int") pairs and strings; nulls change nothing."""
    for v in values:
        if v is None:
            continue
        data = v.encode() if isinstance(v, str) else struct.pack("<i", v[0]) if isinstance(v, tuple) else struct.pack("<q", v)
        seed = xxhash.xxh64_intdigest(data, seed & (1 << 64) - 1)
    return seed - (1 << 64) if seed >> 63 else seed


def documents(spark, rows):
    """(doc_id, text, source) with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", s, 0, "x", 7, "y", 3, "z", 0.5) for i, t, s in rows], ROWS)


def some(n=300):
    return [(i, " ".join(["w"] * (i * 7 % 50)) if i % 11 else None, f"s{i % 5}" if i % 7 else None) for i in range(n)]


def level(sizes, weights, cap=3.0):
    """Targets by resharing the excess until none is above."""
    total, open_, out = sum(sizes), set(range(len(sizes))), {}
    while True:
        left = total - sum(out.values())
        w = sum(weights[i] for i in open_)
        over = {i for i in open_ if left * weights[i] / w > cap * sizes[i] + 1e-9}
        if not over:
            return [out.get(i, left * weights[i] / w if i in open_ else 0) for i in range(len(sizes))]
        out |= {i: cap * sizes[i] for i in over}
        open_ -= over


@pytest.mark.parametrize("sizes", [[10, 1000, 5, 30], [1, 1, 1000], [0, 50, 7], [100, 100, 100, 100, 100]])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(f"s{i}", s) for i, s in enumerate(sizes)], "source string, size long")
    got = [r["target"] for r in mixing.source_targets(df).orderBy("source").collect()]
    weights = [(1.0, 2.0, 3.0)[i % 3] for i in range(len(sizes))]
    assert got == pytest.approx(level(sizes, weights))
    assert sum(got) == pytest.approx(sum(sizes))


def test_mix_is_near_its_targets_and_reruns_agree(spark):
    docs = documents(spark, some())
    rows = mixing.mix_report(docs).collect()
    again = mixing.mix_report(docs.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _, _ in some())
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s]


def plain_mix(rows, targets, cap=3.0, fan=mixing.FAN):
    """doc_id -> copies, of rows with different doc_ids: the pivotal rounding in plain loops."""
    size = {i: len((t or "").split()) for i, t, _ in rows}
    by = defaultdict(list)
    for i, t, source in rows:
        by[source, size[i] == 0].append((i, spark_hash(i, source, t)))
    count = Counter(s for _, _, s in rows)
    largest, out = max(count.values()), {}
    for (source, _), docs in by.items():
        total = sum(size[i] for i, _, s in rows if s == source)
        want = min(targets[source] / total, cap) if total else 1.0
        leaves, decided, rows_of = defaultdict(list), {}, {}
        for i, k in docs:
            rows_of[i] = (max(size[i], 1), k, want // 1)
            leaves[spark_hash(k) % -(-count[source] // fan)].append((max(size[i], 1), k, i, int(want // 1), want - want // 1))
        spread, depth = -(-largest // fan), 0
        while True:
            rest = {}
            for leaf, units in leaves.items():
                a = None
                for u in sorted(units, reverse=True):
                    if a is None:
                        a = u
                        continue
                    up, down = min(a[0] * (1 - a[4]), u[0] * u[4]), min(a[0] * a[4], u[0] * (1 - u[4]))
                    r = ((spark_hash(a[1], u[1], (depth, "int"), (mixing.SEED, "int")) & (1 << 64) - 1) >> 11) / (1 << 53)
                    gains = up + down > 0 and r < down / (up + down)
                    step = up if gains else down
                    ends = a[0] * (1 - a[4]) <= u[0] * u[4] if gains else a[0] * a[4] <= u[0] * (1 - u[4])
                    ended, kept = (a, u) if ends else (u, a)
                    out[ended[2]] = ended[3] + (ends == gains)
                    f = kept[4] + (-1 if ends == gains else 1) * step / kept[0]
                    a = (*kept[:4], min(1.0, max(0.0, f)))
                rest[leaf] = a
            if spread <= 1:
                out.update({a[2]: a[3] + (a[4] >= 0.5) for a in rest.values()})
                (root,) = rest.values()
                ways = []
                for way, off in ((0, root[4] * root[0]), (1, (root[4] - 1) * root[0])):
                    turn = [(s, k, i) for i, (s, k, base) in rows_of.items() if i != root[2] and s <= abs(off) and (off > 0 and out[i] == base and base + 1 <= cap or off < 0 and out[i] == base + 1)]
                    left, taken = abs(off), []
                    for s, _, i in sorted(sorted(turn, key=lambda t: spark_hash(t[1], (mixing.SEED, "int")))[: mixing.POOL], reverse=True):
                        if s <= left:
                            left -= s
                            taken.append(i)
                    ways.append((left, abs(off), way, taken))
                if total and size[docs[0][0]]:
                    _, _, way, taken = min(ways)
                    out[root[2]] = root[3] + way
                    for i in taken:
                        out[i] += -1 if way else 1
                break
            leaves = defaultdict(list)
            for leaf, a in rest.items():
                leaves[leaf // fan].append(a)
            spread, depth = -(-spread // fan), depth + 1
    return out


def test_mix_against_plain_loops(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN", 8)
    rows = [(i, " ".join([f"w{i}"] * (i * 7 % 50 + i // 100 * 300)) if i % 11 else None, f"s{i % 5}" if i % 7 else None) for i in range(300)]
    got = mixing.mix_report(documents(spark, rows)).collect()
    assert {r["doc_id"]: r["copies"] for r in got} == plain_mix(rows, {r["source"]: r["target"] for r in got}, fan=8)
    assert {r["doc_id"]: (r["size"], r["taken"]) for r in got} == {i: (n := len((t or "").split()), n * c["copies"]) for (i, t, _), c in zip(rows, sorted(got, key=lambda r: r["doc_id"]))}


def test_long_texts_and_many_columns(spark):
    """Texts of a million words, and columns named as the operators' own, pass through."""
    long = "word " * 1_000_000
    extra = ["th", "row", "h", "d", "t", "c", "k", "n", "m", "total", "tie", "gone", "no", "body", "late", "first", "_part", "_parts", "spans", "vslot", "part", "unit"]
    docs = spark.createDataFrame([(1, long, "a"), (2, "x\ny\nz", "b")], "doc_id long, text string, source string").select("*", *[F.lit(7).alias(c) for c in extra])
    assert {r["size"] for r in mixing.mix_report(docs).collect()} == {1_000_000, 3}
    for out in (mixing.mix(docs), line_dedup.dedup_lines(docs)):
        assert out.columns[: len(docs.columns)] == docs.columns and out.where("th = 7 and _part = 7").count() >= 1
    assert {r["size"] for r in sharding.assign_shards(docs).collect()} == {5_000_001, 6}
    assert packing.pack(docs, texts=True).agg(F.sum("length")).first()[0] == 1_000_003


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_every_source_is_within_a_hundredth_of_its_target(spark, sf):
    rows = mixing.mix_report(spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
    assert [r["source"] for r in rows.collect() if abs(r["taken"] - r["target"]) > 0.01 * r["target"] + 1] == []


def test_mix_rounds_at_random(spark, monkeypatch):
    """Other seeds pick other documents, as many of them."""
    docs = documents(spark, [(i, "a b c", "s0" if i < 40 else "s1") for i in range(80)])
    picks = set()
    for seed in range(4):
        monkeypatch.setattr(mixing, "SEED", seed)
        low = [r["doc_id"] for r in mixing.mix_report(docs).where("copies = 1 and source = 's0'").collect()]
        assert len(low) == 27
        picks.add(tuple(sorted(low)))
    assert len(picks) == 4


def test_mix_equal_rows_and_carried_columns(spark):
    docs = documents(spark, [(1, "a b", "x")] * 50 + [(2, "c d", "y")] * 50 + [(None, None, None)] * 3)
    report = mixing.mix_report(docs)
    assert report.count() == 103
    by = {r["source"]: r["t"] for r in report.groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert by["x"] + by["y"] == pytest.approx(200, abs=4)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.where("doc_id = 1").count() * 2 == by["x"]


def test_mix_empty(spark):
    docs = documents(spark, [])
    assert mixing.mix_report(docs).count() == 0 and mixing.mix(docs).count() == 0


def test_shards_follow_the_key(spark):
    docs = documents(spark, [*some(2000), *[(None, "t", "s")] * 20, *[(5, "again", "s")] * 3])
    rows = sharding.assign_shards(docs).collect()
    assert len(rows) == 2023
    places = defaultdict(list)
    of = {}
    for r in rows:
        places[r["shard"]].append(r["slot"])
        assert of.setdefault(r["doc_id"], (r["shard"], r["grown_shard"])) == (r["shard"], r["grown_shard"])
        assert r["grown_shard"] in (r["shard"], 16) and 0 <= r["shard"] < 16
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    few = sharding.assign_shards(docs.where("doc_id % 10 = 3")).collect()
    assert all(of[r["doc_id"]] == (r["shard"], r["grown_shard"]) for r in few)
    moved = sum(r["grown_shard"] == 16 for r in rows) / len(rows)
    assert 0.02 < moved < 0.12


def test_shards_against_plain_loops(spark):
    rows = some(500) + [(7, "again", "s"), (7, "again", "s"), (None, "t", "s")]
    got = sharding.assign_shards(documents(spark, rows), 5, 64)
    slot = lambda i: spark_hash(i) % 64
    owner = lambda v, n: max((spark_hash((v, "int"), (s, "int")), s) for s in range(n))[1]
    size = Counter()
    for i, t, _ in rows:
        size[slot(i)] += len((t or "").encode()) + 1
    want = Counter((i, slot(i), owner(slot(i), 5), owner(slot(i), 6), size[slot(i)]) for i, _, _ in rows)
    assert Counter((r["doc_id"], r["vslot"], r["shard"], r["grown_shard"], r["slot_bytes"]) for r in got.collect()) == want
    balanced = Counter()
    for v, s in {(r["vslot"], r["balanced_shard"]) for r in got.collect()}:
        balanced[s] += size[v]
    grown = Counter()
    for v in size:
        grown[owner(v, 6)] += size[v]
    assert max(balanced.values()) <= max(grown.values()) and max(balanced.values()) < 1.5 * sum(size.values()) / 6


def test_a_stored_map_is_edited_by_a_second_run(spark, tmp_path):
    docs, path = documents(spark, some()), str(tmp_path / "map")
    one = {r["doc_id"]: r for r in sharding.assign_shards(docs, 4, 64, path).collect()}
    two = {r["doc_id"]: r for r in sharding.assign_shards(docs, 4, 64, path).collect()}
    assert {v["version"] for v in spark.read.parquet(path).select("version").distinct().collect()} == {1, 2, 3, 4, 5}
    assert all(two[i]["shard"] == one[i]["balanced_shard"] for i in one) and {r["shard"] for r in two.values()} <= set(range(5))
    assert all(r["grown_shard"] in (r["shard"], 5) for r in two.values())
    before = sharding.load_map(spark, path, 3).toDF("v", "vslot", "s").join(sharding.load_map(spark, path), "vslot")
    assert before.where("s <> shard").count() < 64


def test_shards_of_seventeen_are_the_grown_ones(spark):
    docs = documents(spark, some(400))
    grown = {r["doc_id"]: r["grown_shard"] for r in sharding.assign_shards(docs, 16).collect()}
    assert grown == {r["doc_id"]: r["shard"] for r in sharding.assign_shards(docs, 17).collect()}


def test_size_and_checksum(spark):
    r = {x["doc_id"]: x for x in sharding.assign_shards(documents(spark, [(1, "é", "s"), (2, None, "s"), (3, "", "s")])).collect()}
    assert [r[i]["size"] for i in (1, 2, 3)] == [3, 1, 1]
    import zlib

    assert [r[i]["text_crc32"] for i in (1, 2)] == [zlib.crc32("é".encode()), 0]
    assert sharding.assign_shards(documents(spark, [])).count() == 0


def test_rebalance_evens_bytes_and_maps_are_versioned(spark, tmp_path):
    first = sharding.initial_map(spark, 4, 256)
    weights = spark.range(256).select(F.col("id").cast("int").alias("vslot"), F.when(F.col("id") < 40, 1000).otherwise(10).alias("bytes"))
    second = sharding.rebalance(first, weights, 4)
    load = lambda m: [r["b"] for r in m.join(weights, "vslot").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    assert second.count() == 256 and max(load(second)) < max(load(first)) and max(load(second)) - min(load(second)) <= 2000
    path = str(tmp_path / "map")
    sharding.save_map(first, path)
    sharding.save_map(second, path)
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(sharding.load_map(spark, path), second) and same(sharding.load_map(spark, path, 1), first)
    assert {r["shard"] for r in sharding.grow_map(first, 4).join(first.withColumnRenamed("shard", "was"), "vslot").where("shard <> was").collect()} == {4}


def test_chunks_join_to_the_text(spark):
    texts = ["a\nb\nc\nd\ne\nf", "", "\n", "b\nc", "\nb", "one", "b\n\nc\n", "x\n" * 3000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in df.select("text", line_dedup.chunks_of(F.col("text")).alias("c")).collect():
        assert "\n".join(r["c"]) == r["text"]


def brute_lines(rows):
    import hashlib

    def chunks(t):
        lines = t.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        out = []
        for i, line in enumerate(lines):
            if i == 0 or ((h[i - 2] if i > 1 else 0) * 31 + h[i - 1]) % 4 == 0:
                out.append([])
            out[-1].append(line)
        return out

    seen, out = {}, {}
    for i, t in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        kept = []
        for c in chunks(t):
            if len(c) > 1 and "".join(c).strip():
                if tuple(c) in seen and seen[tuple(c)] != (i, t, len(kept)):
                    continue
                seen[tuple(c)] = (i, t, len(kept))
            kept.append("\n".join(c))
        out[i] = "\n".join(kept)
    return out


def test_line_dedup_against_brute_force(spark):
    import random

    rng = random.Random(3)
    passage = [f"shared line {i}" for i in range(30)]
    rows = []
    for i in range(60):
        own = [f"own {i} {j}" for j in range(rng.randrange(12))]
        at = rng.randrange(len(own) + 1)
        rows.append((i, "\n".join(own[:at] + (passage[rng.randrange(3) :] if i % 3 == 0 else []) + own[at:])))
    rows += [(60, None), (61, ""), (62, "\n\n\n"), (63, "\n\n\n")]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    want = brute_lines(rows)
    assert {i: r["text"] for i, r in got.items() if r["text"] is not None} == want
    assert sum(r["_removed_lines"] for r in got.values()) > 100 and got[60]["text"] is None


def test_line_dedup_equal_rows_nulls_and_empty_tables(spark):
    docs = documents(spark, [(1, "a\nb\nc\nd\ne", "s")] * 3 + [(None, "a\nb\nc\nd\ne", "s")] + [(9, "a\nb\nc\nd\ne", "s")])
    rows = line_dedup.dedup_lines(docs).collect()
    assert len(rows) == 5 and len(rows[0]) == len(docs.columns) + 1
    assert {r["text"] for r in rows if r["doc_id"] == 1} == {"a\nb\nc\nd\ne"}
    assert len({r["text"] for r in rows if r["doc_id"] != 1}) == 1 and all(r["_removed_lines"] >= 2 for r in rows if r["doc_id"] != 1)
    assert line_dedup.dedup_lines(documents(spark, [])).count() == 0


def test_line_dedup_keeps_a_place_of_each_body_of_a_hash(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "chunk_hash", lambda body: F.length(body).cast("long"))
    test_line_dedup_against_brute_force(spark)


def test_packing_against_plain_loops(spark):
    rows = [(i, " ".join([f"w{i}"] * (i * 37 % 900 + 1)), "s") for i in range(300)] + [(1000, " ".join(map(str, range(9000))), "s")] + [(2000, "same text", "s")] * 4
    lengths, group = (256, 512, 2048), 64
    pieces, copies = [], Counter()
    for i, t, _ in rows:
        copies[i, t] += 1
        n, k = len(t.split()), spark_hash(i, t)
        pieces += [(spark_hash(k, copies[i, t], p), min(2048, n - p * 2048), i, p, copies[i, t], k) for p in range(-(-n // 2048))]
    buckets = -(-len(pieces) // group)
    want = {}
    for b in range(buckets):
        held = sorted((x for x in pieces if x[0] % buckets == b), key=lambda x: (-x[1], x[2:]))
        where, final, _ = packing.pack_sizes([x[1] for x in held], lengths)
        want |= {(x[2], x[4], x[3]): (x[1], b * (1 << 24) + w, final[w]) for x, w in zip(held, where, strict=True)}
    docs = documents(spark, rows)
    got = packing.pack(docs, lengths, group=group).collect()
    assert {(r["doc_id"], r["copy"], r["piece"]): (r["length"], r["sequence"], r["capacity"]) for r in got} == want and len(got) == len(pieces)
    texts = {i: t.split() for i, t, _ in rows}
    for r in packing.pack(docs, lengths, group=group, texts=True).collect():
        assert want[r["doc_id"], r["copy"], r["piece"]][:2] == (r["length"], r["sequence"])
        assert r["text"].split() == texts[r["doc_id"]][r["start"] : r["start"] + r["length"]]


def test_pack_sizes():
    where, final, cost = packing.pack_sizes([600, 500, 400, 300, 200, 100], (512, 1024, 2048))
    held = Counter()
    for w, s in zip(where, [600, 500, 400, 300, 200, 100]):
        held[w] += s
    assert all(held[i] <= f for i, f in enumerate(final)) and cost == sum(final) + 16 * len(final)
    assert cost <= 2048 + 512 + 32
    assert packing.pack_sizes([100], (512, 1024))[1] == [512]


def test_packing_law(spark):
    rows = [(i, " ".join(["w"] * (i * 37 % 900 + 1)), "s") for i in range(400)] + [(1000, " ".join(["w"] * 9000), "s"), (1001, None, "s"), (1002, "", "s")] + [(5, "same text", "s")] * 4
    out = packing.pack(documents(spark, rows), group=64).collect()
    words, seqs = Counter(), defaultdict(list)
    for r in out:
        words[r["doc_id"]] += r["length"]
        seqs[r["sequence"]].append(r)
    want = Counter()
    for i, t, _ in rows:
        want[i] += len((t or "").split())
    assert words == +want
    waste = 0
    for pieces in seqs.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [p["offset"] for p in pieces] == [sum(x["length"] for x in pieces[:i]) for i in range(len(pieces))]
        used, cap = sum(p["length"] for p in pieces), pieces[0]["capacity"]
        assert used <= cap and cap == min(c for c in packing.LENGTHS if c >= used)
        waste += cap - used
    assert waste < 0.1 * sum(words.values())
    long = sorted((r for r in out if r["doc_id"] == 1000), key=lambda r: r["piece"])
    assert [(r["start"], r["length"]) for r in long] == [(0, 4096), (4096, 4096), (8192, 808)]
    assert packing.pack(documents(spark, [])).count() == 0
