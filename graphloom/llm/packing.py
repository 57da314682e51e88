"""Packing documents into sequences of several permitted lengths by best fit.

A document longer than the largest permitted length is cut into pieces of that
length and a rest. Pieces are dealt into groups of about ``GROUP`` by a hash of
what they are; a group is packed, largest piece first, into the open sequence
that leaves the least room. Where none fits, a sequence of the least-cost length
is opened. Each policy for that (each largest length allowed, or the lowest cost
per token that the group's remaining pieces could fill) is tried, and the
cheapest plan of the group stays, after each sequence has been downsized to the
smallest permitted length that holds its contents.

Defined results: a document without tokens (null or empty text) makes no piece;
equal rows are pieces of their own, told apart by ``copy`` (from 1); no piece is cut but at the largest
length; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, n_words, stage

LENGTHS = (512, 1024, 2048, 4096)
#: Tokens that opening a sequence costs besides its length.
OPEN_COST = 16
GROUP = 8192
COPIES = 256

SCHEMA = "doc_id long, copy long, piece long, start long, length long, sequence long, capacity long, offset long"


def _open_length(size: int, policy: int | None, lengths: Sequence[int], left: int) -> int:
    """The length to open for a piece of ``size``; ``left``: tokens of the group not placed yet, this piece included."""
    fits = [c for c in lengths if c >= size and (policy is None or c <= policy)] or [min(c for c in lengths if c >= size)]
    if policy is not None:
        return fits[-1]
    return min(fits, key=lambda c: ((c + OPEN_COST) / min(c, left), -c))


def pack_sizes(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], int]:
    """Sequence number of each size (given in falling order), each sequence's length, the cost."""
    lengths = sorted(lengths)
    best: tuple[list[int], list[int], int] | None = None
    for policy in [None, *lengths[::-1]]:
        room: list[tuple[int, int]] = []  # (free tokens, sequence), in order
        used: list[int] = []
        where: list[int] = []
        left = sum(sizes)
        for size in sizes:
            at = bisect_left(room, (size, -1))
            if at < len(room):
                free, seq = room.pop(at)
            else:
                free, seq = _open_length(size, policy, lengths, left), len(used)
                used.append(0)
            used[seq] += size
            where.append(seq)
            left -= size
            if free > size:
                insort(room, (free - size, seq))
        final = [lengths[bisect_left(lengths, u)] for u in used]
        cost = sum(final) + OPEN_COST * len(final)
        if best is None or cost < best[2]:
            best = (where, final, cost)
    return best


def _pack_group(lengths: Sequence[int]):
    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "copy", "k"], ascending=[False, True, True, True, True], na_position="last")
        where, final, _ = pack_sizes(group["length"].tolist(), lengths)
        out = group[["doc_id", "copy", "piece", "start", "length"]].copy()
        out["sequence"] = group["bucket"].to_numpy() * (1 << 24) + pd.Series(where, index=group.index)
        out["capacity"] = [final[w] for w in where]
        out["k"] = group["k"]
        out["offset"] = out.groupby("sequence")["length"].cumsum() - out["length"]
        return out[[*(c.split()[0] for c in SCHEMA.split(", ")), "k"]]

    return pack


def pack(docs: DataFrame, lengths: Iterable[int] = LENGTHS, tokens: Column | None = None, group: int = GROUP, texts: bool = False) -> DataFrame:
    """One row a piece: doc_id, copy, piece, start, length, sequence, capacity, offset (place in the sequence).

    ``tokens`` counts a row's tokens; words if not given. Texts are not shuffled, but with ``texts``, which adds each
    piece's words as ``text``.
    """
    if texts and tokens is not None:
        raise ValueError("texts are cut by words")
    lengths = sorted(set(lengths))
    top = lengths[-1]
    count = n_words(F.col("text")) if tokens is None else tokens.cast("long")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), count.alias("n"), F.xxhash64("doc_id", "text").alias("k"), *(["text"] if texts else []))
    # equal rows come together first and are then told apart by number; tokens are counted once
    units = stage(keyed.where("n > 0").groupBy("doc_id", "n", "k").agg(F.count("*").alias("m")))
    total = units.agg(F.sum(F.ceil(F.col("n") / top) * F.col("m"))).first()[0] or 0
    buckets = max(1, -(-int(total) // group))
    pieces = units.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    pieces = pieces.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("n") / top) - 1)))
    pieces = pieces.withColumn("start", F.col("piece") * top).withColumn("length", F.least(F.lit(top), F.col("n") - F.col("start")))
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("k", "copy", "piece"), F.lit(buckets)))
    pieces = pieces.select("doc_id", "piece", "start", "length", "copy", "k", "bucket").groupBy("bucket").applyInPandas(_pack_group(lengths), f"{SCHEMA}, k long")
    if not texts:
        return pieces.drop("k")
    # one row a text and COPIES copies: it is taken apart once, and its pieces are put together out of its words
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    plan = pieces.groupBy("k", F.floor(F.col("copy") / COPIES)).agg(F.collect_list(F.struct(*names)).alias("p"))
    one = keyed.where("n > 0").dropDuplicates(["k"]).select("k", "text")
    cut = lambda w: F.transform("p", lambda x: F.struct(*[x[c].alias(c) for c in names], F.array_join(F.slice(w, (x["start"] + 1).cast("int"), x["length"].cast("int")), " ").alias("text")))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    return one.join(plan.hint("merge"), "k").select(F.inline(F.transform(F.array(words), cut)[0]))
