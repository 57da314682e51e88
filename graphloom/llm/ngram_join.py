"""Similarity join on word n-grams by prefix filters under several global orders of the tokens.

Documents with the same set of shingles (tokens) are one class. Of two sets of Jaccard similarity t or more the first |x| - ceil(t |x|) + 1 tokens
of each share one, whatever order of all tokens they are taken in. A class has that prefix under each of ``ORDERS`` orders. All put
rarer tokens before more frequent ones and those that no other class has before all; among equally
frequent ones each order is a permutation of its own. Two classes are candidates only if they share a token of their prefixes under every order.

Frequencies are counted exactly: tokens go to buckets by their hash, many to a row (4 bytes each and, once a document and bucket, its key),
and only those that two classes have come back, with their frequency. A class whose tokens of its own already fill the prefix can
be linked with nothing and goes no further. Tokens in more than one of ``OFTEN`` documents are at most ``OFTEN`` times as many as a document's mean
number of tokens; their list is broadcast, and they come last in all orders instead of being gathered in one bucket.

The filters are intersected in two steps, neither of which lists the pairs of a token. Classes that a token of the first order's prefixes joins, chained, are a
group; within it the second order's tokens part it into smaller ones, and so on (a class goes with the least class of
its token, so a token makes no more rows than it has classes). Then in each group a class is compared with those that
share a prefix token with it under each order, on full sets, until no two candidates of different components are
left. A group too large for one task is compared in blocks on full sets, as in ``near_dup``.

Hashes of 64 bits stand for shingles; of two that meet in one of a bucket's 32 bits within a document, the prefix is longer by one.

Defined results: a text without words, or null, has an empty set and is linked with nothing; a null doc_id is no component's smallest while another
is there; rows with one doc_id share their component; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import near_dup
from .common import spread_join, stage
from .components import connected_components
from .words import mixed, shingle_sets, together

ORDERS = 3
#: Tokens of a bucket, and tokens that are dealt together.
BUCKET, FLUSH = 1_000_000, 500_000
#: A token in more than one of OFTEN documents, and in LEAST_OFTEN at least, comes last in all orders.
OFTEN, LEAST_OFTEN = 512, 256
_SEEDS = [np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF) for k in range(ORDERS)]
_LAST = 255


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """Some documents (text, doc_id, th) and their sets, about FLUSH tokens at once."""
    rows, sets, n = [], [], 0
    for held in together(row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("text", "doc_id", "th")), strict=True)):
        rows += [(r[1], r[2]) for r in held]
        sets += shingle_sets([r[0] for r in held], size)
        n += sum(map(len, sets[-len(held) :]))
        if n >= FLUSH:
            yield rows, sets
            rows, sets, n = [], [], 0
    if rows:
        yield rows, sets


def _cls(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _describe(size: int):
    def run(batches):
        for rows, sets in _sets(batches, size):
            token, n = np.unique(np.concatenate(sets), return_counts=True)
            many = n * OFTEN >= len(sets)
            many &= n >= max(2, LEAST_OFTEN // 64)
            often = [{"token": t, "n": c} for t, c in zip(token[many].view(np.int64).tolist(), n[many].tolist(), strict=True)]
            yield pa.record_batch(
                [
                    pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(map(len, sets), pa.int64()), pa.array([_cls(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([often, *[None] * (len(rows) - 1)], pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())]))),
                ],
                names=["doc_id", "th", "n_shingles", "cls", "often"],
            )

    return run


_DEALT = "to int, part long, keys binary, counts binary, tokens binary, more binary"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["to", "part", "keys", "counts", "tokens", "more"])


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of equal neighbours begin, and how long they are."""
    first = np.flatnonzero(np.concatenate([np.ones(1, bool), x[1:] != x[:-1]])) if len(x) else np.empty(0, np.int64)
    return first, np.diff(np.append(first, len(x)))


def _new(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs that are not the one before."""
    return np.concatenate([np.ones(min(1, len(a)), bool), (a[1:] != a[:-1]) | (b[1:] != b[:-1])])


def _by(where: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """Columns, which are ordered by ``where``, cut where it changes."""
    first, n = _runs(where)
    for a, m in zip(first.tolist(), n.tolist(), strict=True):
        yield int(where[a]), *(c[a : a + m] for c in columns)


def _packed(keys: np.ndarray) -> tuple[bytes, bytes]:
    """Runs of keys: each once, and how long."""
    first, n = _runs(keys)
    return keys[first].tobytes(), n.astype(np.uint32).tobytes()


def _deal(size: int, buckets: int, often: np.ndarray):
    """Tokens to buckets by hash; to the classes' buckets (-1, -2, ...) what is known of each class without them."""
    def run(batches):
        for _, sets in _sets(batches, size):
            every = {int.from_bytes(_cls(s)[:8]): s for s in sets if len(s)}
            if not every:
                continue
            keys, sets = np.fromiter(every, np.uint64, len(every)), list(every.values())
            n = np.fromiter(map(len, sets), np.int64, len(sets))
            h, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), n)
            last = np.isin(h, often) if len(often) else np.zeros(len(h), bool)
            lasts = np.bincount(of[last], minlength=len(sets))
            # the hashes of a set whose lower halves are equal
            spare = np.array([len(s) - len(np.unique(s.astype(np.uint32))) for s in sets])
            rows, home = [], (keys % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            tokens = [h[a:b][last[a:b]] for a, b in zip(np.cumsum(n) - n, np.cumsum(n))]
            for c, own in _by(home[order], order):
                told = np.stack([n[own], spare[own], lasts[own]]).astype(np.uint32)
                rows.append((-1 - c, -1, keys[own].tobytes(), b"", np.concatenate([tokens[i] for i in own]).tobytes(), told.tobytes()))
            h, of = h[~last], of[~last]
            bucket = ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
            order = np.argsort(bucket, kind="stable")
            for r, t, k in _by(bucket[order], h[order].astype(np.uint32), keys[of[order]]):
                rows.append((r, r, *_packed(k), t.tobytes(), b""))
            yield _batch(rows)

    return run


def _shared(buckets: int):
    """A bucket's tokens that two classes have, back to the classes' buckets with their frequency (on a scale of eighths of powers of two)."""
    def run(table: pa.Table) -> pa.Table:
        if table.column("to")[0].as_py() < 0:
            rows = [(-1 - r["to"], r["part"], r["keys"], r["counts"], r["tokens"], r["more"]) for r in table.to_pylist()]
            return pa.Table.from_batches([_batch(rows)])
        raw = {c: table.column(c).to_pylist() for c in ("keys", "counts", "tokens")}
        keys = np.repeat(np.frombuffer(b"".join(raw["keys"]), np.uint64), np.frombuffer(b"".join(raw["counts"]), np.uint32))
        token = np.frombuffer(b"".join(raw["tokens"]), np.uint32)
        part = table.column("part")[0].as_py()
        del raw
        order = np.lexsort((keys, token))
        keys, token = keys[order], token[order]
        new = _new(keys, token)
        keys, token = keys[new], token[new]
        n = _runs(token)[1]
        n = np.repeat(n, n)
        keys, token, n = keys[n > 1], token[n > 1], n[n > 1]
        level = np.minimum(np.log2(np.maximum(n, 1)) * 8, _LAST - 1).astype(np.uint8)
        order = np.lexsort((keys, keys % np.uint64(buckets)))
        keys, token, level = keys[order], token[order], level[order]
        rows = [(c, part, *_packed(k), t.tobytes(), x.tobytes()) for c, k, t, x in _by((keys % np.uint64(buckets)).astype(np.int64), keys, token, level)]
        return pa.Table.from_batches([_batch(rows)] if rows else [], None if rows else _batch([(0, 0, b"", b"", b"", b"")]).schema)

    return run


def _prefixes(percent: int):
    """The prefixes of a bucket's classes under each order, without the tokens that no other class has."""
    def run(table: pa.Table) -> pa.Table:
        known, keys, token, level = [], [], [], []
        for r in table.select(["part", "keys", "counts", "tokens", "more"]).to_pylist():
            k = np.frombuffer(r["keys"], np.uint64)
            if r["part"] < 0:
                told = np.frombuffer(r["more"], np.uint32).reshape(3, -1).astype(np.int64)
                known.append((k, told))
                k, t = np.repeat(k, told[2]), np.frombuffer(r["tokens"], np.uint64)
                level.append(np.full(len(t), _LAST, np.uint8))
            else:
                k, t = np.repeat(k, np.frombuffer(r["counts"], np.uint32)), np.frombuffer(r["tokens"], np.uint32).astype(np.uint64) | np.uint64(r["part"] << 32)
                level.append(np.frombuffer(r["more"], np.uint8))
            keys.append(k)
            token.append(t)
        cls, at = np.unique(np.concatenate([k for k, _ in known]), return_index=True)
        n, spare, _ = np.concatenate([t for _, t in known], axis=1)[:, at]
        keys, token, level = np.concatenate(keys), np.concatenate(token), np.concatenate(level)
        # what is told of a class by several tasks counts once
        order = np.lexsort((token, keys))
        keys, token, level = keys[order], token[order], level[order]
        new = _new(keys, token)
        keys, token, level = keys[new], token[new], level[new]
        of = np.searchsorted(cls, keys)
        left = n + (-percent * n) // 100 + 1 + spare - (n - np.bincount(of, minlength=len(cls)))
        some = left[of] > 0
        of, token, level = of[some], token[some], level[some]
        out = []
        for k, seed in enumerate(_SEEDS):
            order = np.lexsort((mixed(token ^ seed), level, of))
            first, size = _runs(of[order])
            place = np.arange(len(order)) - np.repeat(first, size)
            taken = order[place < left[of[order]]]
            out.append((np.full(len(taken), k, np.int8), cls[of[taken]].view(np.int64), token[taken].view(np.int64)))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], names=["ord", "key", "token"])

    return run


def prefixes(texts: DataFrame, size: int, percent: int, total: int, often: np.ndarray) -> DataFrame:
    """(ord, key, token): what each class must share with whatever it is linked with, under each order."""
    buckets = max(1, -(-total // BUCKET))
    dealt = texts.mapInArrow(_deal(size, buckets, often), _DEALT)
    shared = dealt.groupBy("to").applyInArrow(_shared(buckets), _DEALT)
    return stage(shared.groupBy("to").applyInArrow(_prefixes(percent), "ord byte, key long, token long"))


def _together(prefix: DataFrame, groups: DataFrame | None) -> DataFrame:
    """(key, label): classes that tokens of one order join, within their groups so far."""
    on = ["token"] if groups is None else ["label", "token"]
    held = prefix.select("key", "token") if groups is None else stage(prefix.join(groups, "key").select("key", "label", "token"))
    least = stage(held.groupBy(*on).agg(F.min("key").alias("m"), F.count("*").alias("n")).where("n > 1"))
    edges = spread_join(held, least, on).where("key <> m").select(F.col("key").alias("a"), F.col("m").alias("b"))
    return stage(connected_components(edges).toDF("key", "label"))


def candidates(prefix: DataFrame) -> DataFrame:
    """(key, label): groups outside which no two classes share a prefix token under all orders."""
    groups = None
    for k in range(ORDERS):
        groups = _together(prefix.where(F.col("ord") == k), groups)
    return groups


def confirmed(sets: list[np.ndarray], prefix: list[list[np.ndarray]], percent: int) -> np.ndarray:
    """A component number for each set, as ``near_dup.confirmed``; a set is compared with those that share a prefix token with it under each order."""
    group, orders = near_dup._Group(sets), [near_dup._Group(p) for p in prefix]
    label, done = np.arange(len(sets)), np.zeros(len(sets), bool)
    while True:
        counts = np.bincount(label, minlength=len(sets))
        open_ = np.flatnonzero((label != counts.argmax()) & ~done)
        if done.any() and not len(open_):
            return label
        i = open_[0] if len(open_) else 0
        done[i] = True
        met = np.logical_and.reduce([o.shared(i) > 0 for o in orders])
        met[i] = True
        if met.sum() <= 16:
            near = np.flatnonzero(met)
            both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in near])
            near = near[100 * both >= percent * (group.sizes[near] + group.sizes[i] - both)]
        else:
            near = np.flatnonzero(met & group.linked(i, percent))
        joined = np.unique(label[near])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]


def _confirm(size: int, percent: int):
    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in bucket.groupby("label", sort=False):
            cls = group["cls"].tolist()
            prefix = [[np.asarray(x, np.int64) for x in group[f"p{k}"]] for k in range(ORDERS)]
            label = confirmed(shingle_sets(group["text"].tolist(), size), prefix, percent)
            out.append(pd.DataFrame({"a": cls, "b": [cls[x] for x in label.tolist()]}))
        return pd.concat(out)

    return run


def join(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, th, n_shingles, component_id, kept, part for each row, as ``near_dup.near_duplicates``, with every link."""
    texts = near_dup.keyed(docs)
    schema = "doc_id long, th long, n_shingles long, cls binary, often array<struct<token:long,n:long>>"
    rows = stage(texts.mapInArrow(_describe(size), schema))
    docs_n, total = rows.agg(F.count("*"), F.sum("n_shingles")).first()
    counts = rows.select(F.inline("often")).groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > max(LEAST_OFTEN, docs_n // OFTEN))
    often = np.sort(np.array([r["token"] for r in counts.select("token").toLocalIterator()], np.int64).view(np.uint64))
    rows = rows.drop("often")
    classes = stage(near_dup.classes_of(rows))
    prefix = prefixes(texts, size, percent, total or 0, often)
    groups = candidates(prefix)
    lists = prefix.join(groups, "key").groupBy("key", "label").agg(*(F.collect_list(F.when(F.col("ord") == k, F.col("token"))).alias(f"p{k}") for k in range(ORDERS)))
    # a class's key is the first 8 bytes of its name
    key = F.conv(F.hex(F.substring("cls", 1, 8)), 16, -10).cast("long")
    named = classes.select("cls", key.alias("key")).join(lists, "key").drop("key")
    return near_dup.settled(texts, rows, classes, stage(named), size, percent, _confirm(size, percent))
