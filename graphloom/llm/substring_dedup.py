"""Substring dedup: repeated windows of words, by compaction of a de Bruijn graph.

The edges of the graph are k-mers of ``WINDOW`` words, its nodes the (``WINDOW`` - 1)-mers
that these lead from and to. A document is a walk. No edge is handed on alone
where it need not be: each window holds an anchor, the ``ANCHOR`` words of least hash in it, and
a walk is cut at its anchors into paths of some twenty edges (equal passages are cut alike), each a row
with its nodes, the hash of all its words, and its place.

Paths that begin with an anchor no other document has cannot repeat and go no further. Of the others, those
that occur in several documents make the graph. Their nodes' in- and out-degrees are counted; where a node
has one path in and one out, and both stand side by side in the source (the smallest doc_id
that has them), a join makes the first the head of the second, and joins in rounds, each twice as far as
the one before, compact every such chain into one path. A later document's walk along a compacted path is one span, told by
coordinates: its own and the source's. The words at the source's coordinates are
hashed (BLAKE2b), and a span goes only if its own words have that hash.

Compaction ends where paths part inside a stretch between two anchors. There, and only there,
single edges are opened: those around anchors that an unsettled window shares with a smaller doc_id. Equal
edges are found by two hashes, of their words' bytes and of their words' hashes.

Defined results: a null text has no words; a document with a null doc_id loses
nothing and is nobody's source; rows with one doc_id never remove
words from each other; an empty table gives an empty result; other columns are carried, whatever their
names, but for columns called ``_n_words``, ``_n_removed`` or ``_kept``, which the results replace.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import spread_join, stage
from .words import Runs, Tokens, signed, together

WINDOW = 50
ANCHOR = 12
#: Coordinates of one source document that are looked up in one go.
ASKED = 1024
_FLUSH = 100_000


def _slide(x: np.ndarray, size: int, what) -> np.ndarray:
    """what (minimum or maximum) of each run of ``size`` values, by doubling."""
    done, out = 1, x
    while done < size:
        by = min(done, size - done)
        out = what(out[:-by], out[by:])
        done += by
    return out


class _Walks:
    """Some documents' words one after another, their anchors and their paths; each document has a window or more."""

    def __init__(self, tokens: Tokens, window: int, k: int):
        self.begins, sizes = tokens.begins, tokens.counts
        self.runs = runs = Runs(tokens.hashes)
        start = np.arange(runs.n - k + 1)
        h = runs.hash(start, start + k)
        span = window - k + 1
        least = _slide(h, span, np.minimum)  # of the window that starts here
        last = np.repeat(self.begins + sizes - window, sizes)[: len(least)]  # the document's last window
        least[np.arange(len(least)) > last] = 0  # no window, but words of two documents
        pad = np.zeros(span - 1, np.uint64)
        self.anchors = np.flatnonzero(_slide(np.concatenate([pad, least, pad]), span, np.maximum) == h)
        #: Edges from, to (exclusive) of the paths that begin at each document's first word and at each anchor; none (to = from) beyond the last edge.
        self.lo = np.union1d(self.begins, self.anchors)
        self.document = np.searchsorted(self.begins, self.lo, "right") - 1
        ends = (self.begins + sizes - window + 1)[self.document]
        self.hi = np.maximum(self.lo, np.minimum(np.append(self.lo[1:], runs.n), ends))


def _spelling(tokens: Tokens, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of the words from lo to hi (exclusive, above lo)."""
    of, data = xxhash.xxh3_64_intdigest, tokens.bytes.data
    return np.fromiter((of(data[a:b]) for a, b in zip(tokens.starts[lo].tolist(), tokens.ends[hi - 1].tolist(), strict=True)), np.uint64, len(lo))


def _digest(tokens: Tokens, lo: int, hi: int) -> bytes:
    return hashlib.blake2b(tokens.spelled(lo, hi), digest_size=16).digest()


def _batches(fields: list[tuple[str, pa.DataType]], rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Joins tuples of equally long arrays into batches of about _FLUSH rows."""
    kept, n = [], 0
    schema = pa.schema(fields)

    def flush():
        return pa.record_batch([pa.array(np.concatenate(c), t) for c, (_, t) in zip(zip(*kept, strict=True), fields, strict=True)], schema=schema)

    for row in rows:
        if len(row[0]):
            kept.append(row)
            n += len(row[0])
        if n >= _FLUSH:
            yield flush()
            kept, n = [], 0
    if kept:
        yield flush()


def _documents(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """Some documents at once: their words, and the columns named."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in ("text", *names)), strict=True))
    for held in together(rows):
        texts, *columns = zip(*held, strict=True)
        yield Tokens(list(texts)), *columns


def _same(value: int, n: int) -> np.ndarray:
    return np.full(n, value, np.int64)


_PATHS = [(c, pa.int64()) for c in ("h", "word", "node", "to_node", "doc_id", "th")] + [("lo", pa.int32()), ("hi", pa.int32())]
_KIND = {pa.int64(): "long", pa.int32(): "int", pa.binary(): "binary"}


def _ddl(fields: list[tuple[str, pa.DataType]]) -> str:
    return ", ".join(f"{c} {_KIND[t]}" for c, t in fields)


def _walks(window: int, k: int):
    """A row for each anchor with the path that begins there, and for a document's first path."""

    def rows(held: list[tuple]) -> tuple | None:
        texts, doc_ids, hashes = zip(*held, strict=True)
        tokens = Tokens(list(texts))
        long = tokens.counts >= window
        if not long.all():
            held = [row for row, keep in zip(held, long.tolist(), strict=True) if keep]
            return rows(held) if held else None
        walks = _Walks(tokens, window, k)
        lo, hi, runs = walks.lo, walks.hi, walks.runs
        some = hi > lo
        a, b = lo[some], hi[some]
        word, node, to = (np.zeros(len(lo), np.uint64) for _ in range(3))
        word[some] = _spelling(tokens, a, b + window - 1)
        node[some], to[some] = runs.hash(a, a + window - 1), runs.hash(b, b + window - 1)
        doc_id, th = (np.array(column, np.int64)[walks.document] for column in (doc_ids, hashes))
        begin = walks.begins[walks.document]
        return signed(runs.hash(lo, lo + k)), signed(word), signed(node), signed(to), doc_id, th, (lo - begin).astype(np.int32), (hi - begin).astype(np.int32)

    def run(batches):
        # a window has this many characters at least
        columns = (zip(*(batch.column(c).to_pylist() for c in ("text", "doc_id", "th")), strict=True) for batch in batches)
        fit = (row for rows_ in columns for row in rows_ if row[1] is not None and len(row[0] or "") >= 2 * window - 1)
        yield from _batches(_PATHS, (found for held in together(fit) if (found := rows(held)) is not None))

    return run


def _covered(n: int, lo: list[int], hi: list[int]) -> np.ndarray:
    """For each place below n, whether an interval [lo, hi) holds it."""
    open_ = np.zeros(n + 1, np.int64)
    np.add.at(open_, np.clip(np.array(lo, np.int64), 0, n), 1)
    np.add.at(open_, np.clip(np.array(hi, np.int64), 0, n), -1)
    return np.cumsum(open_)[:-1] > 0


def _open_anchors(window: int, k: int):
    """Hashes of anchors shared with a smaller doc_id that some unsettled window may hold."""

    def run(batches):
        for batch in batches:
            out = []
            for shared, settled in zip(batch.column("shared").to_pylist(), batch.column("settled").to_pylist(), strict=True):
                n = max(s["at"] for s in shared) + 1
                done = _covered(n, [s["lo"] for s in settled or ()], [s["hi"] for s in settled or ()])
                held = np.concatenate([[0], np.cumsum(~done)])
                out += [s["h"] for s in shared if s["smaller"] and held[s["at"] + 1] > held[max(0, s["at"] - (window - k))]]
            yield pa.record_batch([pa.array(out, pa.int64())], names=["h"])

    return run


_EDGES = [(c, pa.int64()) for c in ("word", "mix", "doc_id", "th")] + [("lo", pa.int32())]


def _open_edges(window: int, k: int):
    """The unsettled single edges that hold an opened anchor."""

    def run(batches):
        def rows():
            for tokens, *columns in _documents(batches, "doc_id", "th", "opened", "settled"):
                runs = Runs(tokens.hashes)
                for begin, count, doc_id, th, opened, settled in zip(tokens.begins.tolist(), tokens.counts.tolist(), *columns, strict=True):
                    n = count - window + 1
                    near = _covered(n, [at - (window - k) for at in opened], [at + 1 for at in opened])
                    done = _covered(n, [s["lo"] for s in settled or ()], [s["hi"] for s in settled or ()])
                    start = np.flatnonzero(near & ~done)
                    if len(start):
                        at = begin + start
                        yield signed(_spelling(tokens, at, at + window)), signed(runs.hash(at, at + window)), _same(doc_id, len(at)), _same(th, len(at)), start.astype(np.int32)

        yield from _batches(_EDGES, rows())

    return run


_LOOKED_UP = [("s_doc", pa.int64()), ("s_th", pa.int64()), ("s_lo", pa.int32()), ("s_hi", pa.int32()), ("digest", pa.binary())]


def _look_up(batches):
    """The digest of the words at each of a source's coordinates."""

    def rows():
        for tokens, *columns in _documents(batches, "doc_id", "th", "asked"):
            for begin, doc_id, th, asked in zip(tokens.begins.tolist(), *columns, strict=True):
                lo, hi = (np.array([a[c] for a in asked], np.int32) for c in ("s_lo", "s_hi"))
                digests = [_digest(tokens, begin + a, begin + b) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                yield _same(doc_id, len(asked)), _same(th, len(asked)), lo, hi, np.array(digests, object)

    yield from _batches(_LOOKED_UP, rows())


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text, row): the row's place and text, and its other columns, if it has any, as one.

    A table of doc_id and text alone is dealt in the same form to all joins, so that one shuffle serves them.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != "text" and (c, docs.schema[c].dataType.simpleString()) != ("doc_id", "bigint")]
    row = [F.struct(*rest).alias("row")] if rest else []
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text", *row)


def _on_key(keyed: DataFrame, more: DataFrame, how: str) -> DataFrame:
    """Joins more, keyed by (doc_id, th), to keyed documents. Always dealt by that key: one shuffle of the texts serves all such joins."""
    more = more.withColumnsRenamed({"doc_id": "_d", "th": "_t"}).hint("merge")
    return keyed.join(more, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")), how).drop("_d", "_t")


def degrees(known: DataFrame) -> DataFrame:
    """(node, n_in, n_out, before, after): how many different repeated paths lead to and from each node that has both, and the least of each."""
    source = F.struct("s_doc", "s_th", "s_lo", "s_hi")
    into = known.groupBy(F.col("to_node").alias("node")).agg(F.count("*").alias("n_in"), F.min(source).alias("before"))
    out = known.groupBy("node").agg(F.count("*").alias("n_out"), F.min(source).alias("after"))
    return into.join(out, "node")


def compacted(known: DataFrame) -> DataFrame:
    """``known`` with ``head``: where in its source the nonbranching chain of paths begins that a path belongs to."""
    inner = degrees(known).where("n_in = 1 and n_out = 1 and before.s_doc = after.s_doc and before.s_th = after.s_th and before.s_hi = after.s_lo")
    key = ["s_doc", "s_th", "s_lo"]
    heads = stage(inner.select("after.s_doc", "after.s_th", "after.s_lo", F.col("before.s_lo").alias("head")))
    while True:
        further = heads.select("s_doc", "s_th", F.col("s_lo").alias("head"), F.col("head").alias("up"))
        step = stage(heads.join(further, ["s_doc", "s_th", "head"], "left").select(*key, F.coalesce("up", "head").alias("head"), F.col("up").isNotNull().alias("moved")))
        heads = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    return known.join(heads, key, "left").withColumn("head", F.coalesce("head", "s_lo"))


def _walked(late: DataFrame, window: int) -> DataFrame:
    """Later documents' paths put together where they go on along one compacted path: (doc_id, th, lo, hi, s_doc, s_th, s_lo, s_hi) in words."""
    run = ["doc_id", "th", "s_doc", "s_th", "head", "shift"]
    late = late.withColumn("shift", F.col("lo") - F.col("s_lo"))
    order = Window.partitionBy(*run).orderBy("lo")
    begins = (F.coalesce(F.lag("hi").over(order), F.lit(-1)) != F.col("lo")).cast("int")
    late = late.withColumn("begins", begins).withColumn("no", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = late.groupBy(*run, "no").agg(F.min("lo").alias("lo"), (F.max("hi") + (window - 1)).alias("hi"))
    return spans.select("doc_id", "th", "lo", "hi", "s_doc", "s_th", (F.col("lo") - F.col("shift")).alias("s_lo"), (F.col("hi") - F.col("shift")).alias("s_hi"))


def _verified(spans: DataFrame, keyed: DataFrame) -> DataFrame:
    """Spans with the ``digest`` of the words at their source's coordinates."""
    at = ["s_doc", "s_th", "s_lo", "s_hi"]
    asked = stage(spans.groupBy(*at).agg(F.count("*").alias("n")))
    doc = Window.partitionBy("s_doc", "s_th")
    part = F.pmod(F.xxhash64("s_lo", "s_hi"), F.ceil(F.count("*").over(doc) / ASKED))
    wanted = asked.withColumn("part", part).groupBy(F.col("s_doc").alias("doc_id"), F.col("s_th").alias("th"), "part").agg(F.collect_set(F.struct("s_lo", "s_hi")).alias("asked"))
    # rows equal in doc_id and text are one source
    found = _on_key(keyed.select("doc_id", "th", "text"), wanted, "inner").mapInArrow(_look_up, _ddl(_LOOKED_UP)).groupBy(*at).agg(F.first("digest").alias("digest"))
    return spread_join(spans, stage(found.join(asked, at)), at)


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """(doc_id, th, spans): the words [lo, hi) of a document in windows that a smaller doc_id has too, and, for spans of several, the digest of the source's words.

    th is xxhash64 of the text.
    """
    key = ["doc_id", "th"]
    keyed = _keyed(docs)
    walks = stage(keyed.select(*key, "text").mapInArrow(_walks(window, k), _ddl(_PATHS)))
    least, most, n = F.min("doc_id").alias("least"), F.max("doc_id").alias("most"), F.count("*").alias("n")
    several = lambda rows, *by: stage(rows.groupBy(*by).agg(least, most, n).where("least < most").drop("most"))
    anchored = several(walks, "h")
    shared = stage(spread_join(walks, anchored, ["h"]).withColumn("smaller", F.col("least") < F.col("doc_id")).drop("least", "n"))
    path = ["word", "node", "to_node"]
    source = F.min(F.struct("doc_id", "th", "lo", "hi")).alias("s")
    edges = shared.where("hi > lo").select(*path, *key, "lo", "hi")
    known = edges.groupBy(*path).agg(source, most, n).where("s.doc_id < most")
    known = stage(known.select(*path, F.col("s.doc_id").alias("s_doc"), F.col("s.th").alias("s_th"), F.col("s.lo").alias("s_lo"), F.col("s.hi").alias("s_hi"), "n"))
    known = stage(compacted(known).select(*path, "s_doc", "s_th", "s_lo", "head", "n"))
    late = spread_join(edges, known, path).where("s_doc < doc_id")
    spans = stage(_walked(late.select(*key, "lo", "hi", "s_doc", "s_th", "s_lo", "head"), window))
    settled = spans.groupBy(*key).agg(F.collect_set(F.struct("lo", (F.col("hi") - (window - 1)).alias("hi"))).alias("settled"))
    by_doc = shared.groupBy(*key).agg(F.collect_set(F.struct(F.col("lo").alias("at"), "h", "smaller")).alias("shared"))
    opening = by_doc.join(settled, key, "left").select("shared", "settled").mapInArrow(_open_anchors(window, k), "h long").distinct()
    opened = spread_join(shared.select("h", *key, "lo"), stage(anchored.select("h", "n").join(opening, "h")), ["h"])
    opened = stage(opened.groupBy(*key).agg(F.collect_set("lo").alias("opened")).join(settled, key, "left"))
    singles = _on_key(keyed.select(*key, "text"), opened, "inner").mapInArrow(_open_edges(window, k), _ddl(_EDGES))
    found = spread_join(singles, several(singles, "word", "mix"), ["word", "mix"]).where("least < doc_id")
    # windows that follow on each other are one span
    order = Window.partitionBy(*key).orderBy("lo")
    found = found.select(*key, "lo").distinct().withColumn("run", F.col("lo") - F.row_number().over(order))
    found = found.groupBy(*key, "run").agg(F.min("lo").alias("lo"), (F.max("lo") + window).alias("hi"))
    parts = [_verified(spans, keyed).select(*key, "lo", "hi", "digest"), found.select(*key, "lo", "hi", F.lit(None).cast("binary").alias("digest"))]
    # a union that takes its parts for equally partitioned can fail once AQE has coalesced one of them: keys are new expressions
    parts = [p.withColumns({c: F.col(c) + 0 for c in key}) for p in parts]
    return parts[0].union(parts[1]).groupBy(*key).agg(F.collect_set(F.struct("lo", "hi", "digest")).alias("spans"))


def _remove(batches):
    for whole in batches:
        texts, at = whole.column("text").to_pylist(), 0
        for held in together((t,) for t in texts):
            batch, at = whole.slice(at, len(held)), at + len(held)
            tokens = Tokens([t for t, in held])
            keep = np.ones(len(tokens.ends), bool)
            for begin, count, spans in zip(tokens.begins.tolist(), tokens.counts.tolist(), batch.column("spans").to_pylist(), strict=True):
                sure = [s for s in spans or () if s["digest"] is None or s["digest"] == _digest(tokens, begin + s["lo"], begin + s["hi"])]
                if sure:
                    keep[begin : begin + count] = ~_covered(count, [s["lo"] for s in sure], [s["hi"] for s in sure])
            left = tokens.bytes[np.repeat(keep, tokens.ends + 1 - tokens.starts)].tobytes()
            ends = np.concatenate([[0], np.cumsum(np.where(keep, tokens.ends + 1 - tokens.starts, 0))])
            cuts = ends[np.append(tokens.begins, len(keep))].tolist()
            kept = [left[a : max(a, b - 1)].decode() for a, b in zip(cuts, cuts[1:])]
            gone = np.concatenate([[0], np.cumsum(~keep)])[np.append(tokens.begins, len(keep))]
            rest = [c for c in batch.schema.names if c != "spans"]
            yield pa.record_batch(
                [*(batch.column(c) for c in rest), pa.array(tokens.counts, pa.int64()), pa.array(np.diff(gone), pa.int64()), pa.array(kept, pa.string())],
                names=[*rest, "_n_words", "_n_removed", "_kept"],
            )


def dedup_substrings(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR) -> DataFrame:
    """``docs`` with ``_n_words``, ``_n_removed`` and ``_kept``, the words that stay joined by one space."""
    results = ("_n_words", "_n_removed", "_kept")
    docs = docs.drop(*results)
    joined = _on_key(_keyed(docs), repeated_spans(docs, window, k), "left").drop("th")
    schema = joined.drop("spans").schema.add("_n_words", "long").add("_n_removed", "long").add("_kept", "string")
    out = joined.mapInArrow(_remove, schema)
    inside = joined.schema["row"].dataType.names if "row" in joined.columns else []
    return out.select(*[F.col(f"row.`{c}`").alias(c) if c in inside else F.col(c) for c in docs.columns], *results)
