"""Near-duplicates by chosen-path set similarity join on word shingles.

Documents with the same shingle set are one class. A class embeds its set as
``EMBED`` minwise tokens. A tree of chosen paths starts at the empty path; where a
node holds many classes, each goes on to the children its path chooses among
its tokens, so that two similar sets go on together with a high chance and two
unlike ones part. A step takes ``STEP`` tokens at once; ``TREES`` (first level) and
``BRANCHES`` (below) independent choices bring the chance that a pair of
the least similarity meets in no node under 0.1 %. A node with few classes
is compared exhaustively by the embedding. A crowded node first sets aside what is much
like one of its leaders, in a group with it; the rest branches on.

All this only says which classes may be linked, with a wide margin: classes that may be linked form a
suspect group, and in each group links are confirmed on the full sets until no
two classes of different components are left untested. A group too large for
one task is tested in blocks against pivots instead.

Defined results: a text without words, or null, has an empty set, is linked with
nothing and is its own component; a null doc_id never is a component's
smallest while another is there, and such a row is kept only where it is alone;
rows with one doc_id share their component; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_join, stage
from .components import connected_components
from .words import mixed, shingle_sets

EMBED = 64
STEP = 3
TREES = 12
BRANCHES = 8
DEPTH = 3
#: Classes of a node that are compared with each other.
NODE = 64
#: Classes of a crowded node that all its classes are compared with.
LEADERS = 8
#: Least estimated similarity of a suspect pair, and of a class and its leader; and from where on a class is set aside as a leader's copy.
#: What is linked with a class set aside is so near that leader as to be its suspect, and so in one group with both.
SUSPECT, LEADER_SUSPECT, COPY = 0.5, 0.4, 0.7
#: A group of more shingles or classes than these is tested in blocks.
GROUP_SHINGLES, GROUP_CLASSES = 6_000_000, 30_000
BUCKET_SHINGLES = 2_000_000
PIVOTS, SHARD = 64, 1024
PIVOT_SHINGLES, SHARD_SHINGLES = 200_000, 2_000_000

_rng = np.random.default_rng(7)
_MUL = (_rng.integers(1, 1 << 63, EMBED, np.int64).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, EMBED, np.int64).astype(np.uint64)


def embed(shingles: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set, as EMBED 32-bit values."""
    out = np.full(EMBED, 0xFFFFFFFF, np.uint64)
    for part in np.array_split(shingles, max(1, len(shingles) // 4096)):
        out = np.minimum(out, ((part[:, None] * _MUL + _ADD) >> np.uint64(32)).min(axis=0))
    return out.astype(np.uint32)


def _describe(size: int):
    def run(batches):
        for batch in batches:
            n, cls, sig = [], [], []
            for s in shingle_sets(batch.column("text").to_pylist(), size):
                n.append(len(s))
                cls.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(embed(s).tobytes() if len(s) else None)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(cls, pa.binary()), pa.array(sig, pa.binary())],
                names=["doc_id", "th", "n_shingles", "cls", "sig"],
            )

    return run


def _matrix(sigs) -> np.ndarray:
    return np.frombuffer(b"".join(sigs), np.uint32).reshape(-1, EMBED)


def child_paths(path: np.ndarray, sig: np.ndarray, branches: int) -> np.ndarray:
    """(classes, branches) paths one step below: a path and a branch choose STEP places of the embedding, whose tokens extend it."""
    out = np.empty((len(sig), branches), np.uint64)
    rows = np.arange(len(sig))
    for b in range(branches):
        state = mixed(path + np.uint64(0x9E3779B97F4A7C15 * (b + 1) & 0xFFFFFFFFFFFFFFFF))
        grown = state
        for _ in range(STEP):
            state = mixed(state + np.uint64(0x632BE59BD9B4E019))
            token = sig[rows, (state % np.uint64(EMBED)).astype(np.int64)].astype(np.uint64)
            grown = mixed(grown ^ mixed(token + state))
        out[:, b] = grown
    return out


def _branch(branches: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column("sig").to_pylist())
            path = batch.column("path").to_numpy().view(np.uint64)
            paths = child_paths(path, sig, branches).reshape(-1)
            cls = batch.column("cls").take(pa.array(np.repeat(np.arange(len(sig)), branches)))
            yield pa.record_batch([pa.array(paths.view(np.int64)), cls], names=["path", "cls"])

    return run


def _compare_nodes(batches):
    """Small nodes: a forest of suspect pairs (estimated similarity of SUSPECT or more) of each."""
    for batch in batches:
        left, right = [], []
        for members in batch.column("members").to_pylist():
            cls = [m["cls"] for m in members]
            sig = _matrix([m["sig"] for m in members])
            group = np.arange(len(cls))
            for i in range(len(cls) - 1):
                near = np.flatnonzero((sig[i + 1 :] == sig[i]).sum(axis=1) >= SUSPECT * EMBED) + i + 1
                for j in near.tolist():
                    if group[j] != group[i]:
                        group[group == group[j]] = group[i]
                        left.append(cls[i])
                        right.append(cls[j])
        yield pa.record_batch([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])


def _to_leaders(batches):
    """Crowded nodes: a class's first suspect leader, other leaders this joins to that one, and the largest share of tokens it has in common with one."""
    for batch in batches:
        sig = _matrix(batch.column("sig").to_pylist())
        edges, alike, joined = [], [], set()
        for cls, own, leaders in zip(batch.column("cls").to_pylist(), sig, batch.column("leaders").to_pylist(), strict=True):
            same = (_matrix([x["sig"] for x in leaders]) == own).mean(axis=1)
            near = [leaders[i]["cls"] for i in np.flatnonzero(same >= LEADER_SUSPECT)]
            new = [(near[0], x) for x in near[1:] if (near[0], x) not in joined]
            joined.update(new)
            edges.append([{"a": a, "b": b} for a, b in [*((near[0], cls) for _ in near[:1]), *new] if a != b])
            alike.append(float(same.max()))
        rest = ["path", "cls", "sig", "first"]
        pairs = pa.array(edges, pa.list_(pa.struct([("a", pa.binary()), ("b", pa.binary())])))
        yield pa.record_batch([*(batch.column(c) for c in rest), pairs, pa.array(alike, pa.float64())], names=[*rest, "edges", "alike"])


def suspect_pairs(classes: DataFrame) -> DataFrame:
    """(a, b) pairs of classes that connect all classes which may be linked; classes: (cls, sig)."""
    level = classes.select(F.lit(0).cast("long").alias("path"), "cls", "sig").mapInArrow(_branch(TREES), "path long, cls binary")
    pairs = None
    for depth in range(1, DEPTH + 1):
        level = stage(level)
        counts = stage(level.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"))
        held = stage(spread_join(level, counts, ["path"]).join(classes, "cls"))
        few = held.where(F.col("n") <= NODE).groupBy("path").agg(F.collect_list(F.struct("cls", "sig")).alias("members"))
        found = few.mapInArrow(_compare_nodes, "a binary, b binary")
        many = held.where(F.col("n") > NODE)
        lots = many.groupBy("path", F.pmod(F.xxhash64("cls"), F.lit(LEADERS)).alias("lot")).agg(F.min(F.struct("cls", "sig")).alias("l"), F.count("*").alias("crowd"))
        leaders = lots.groupBy("path").agg(F.sort_array(F.collect_list("l")).alias("leaders"), F.min("l.cls").alias("first"), F.sum("crowd").alias("crowd"))
        leaders = stage(leaders)
        measured = stage(spread_join(many, leaders, ["path"], "crowd").mapInArrow(_to_leaders, "path long, cls binary, sig binary, first binary, edges array<struct<a:binary,b:binary>>, alike double"))
        found = found.union(measured.select(F.inline("edges")))
        if depth == DEPTH:
            found = found.union(measured.select("cls", "first"))
        pairs = found if pairs is None else pairs.union(found)
        if measured.isEmpty():
            break
        level = measured.where(F.col("alike") < COPY).select("path", "cls", "sig").mapInArrow(_branch(BRANCHES), "path long, cls binary")
    return pairs


class _Group:
    """The shingle sets of some classes, for counting shares with one of them at a time."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        words, self.at = np.unique(np.concatenate(sets), return_inverse=True)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        self.mark = np.zeros(len(words), bool)

    def shared(self, i: int) -> np.ndarray:
        own = self.at[self.starts[i] : self.ends[i]]
        self.mark[own] = True
        counts = np.add.reduceat(self.mark[self.at].astype(np.int64), self.starts)
        self.mark[own] = False
        return counts

    def linked(self, i: int, percent: int) -> np.ndarray:
        both = self.shared(i)
        return 100 * both >= percent * (self.sizes + self.sizes[i] - both)


def confirmed(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """A component number for each set.

    A set outside the largest component so far is compared with all, until
    all of those have been; then any two of different components have been compared.
    """
    group, label, done = _Group(sets), np.arange(len(sets)), np.zeros(len(sets), bool)
    while True:
        counts = np.bincount(label, minlength=len(sets))
        open_ = np.flatnonzero((label != counts.argmax()) & ~done)
        if done.any() and not len(open_):
            return label
        i = open_[0] if len(open_) else 0
        done[i] = True
        joined = np.unique(label[group.linked(i, percent)])
        if len(joined) > 1:
            label[np.isin(label, joined)] = joined[0]


def _confirm_bucket(size: int, percent: int):
    def run(bucket: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, group in bucket.groupby("label", sort=False):
            cls = group["cls"].tolist()
            label = confirmed(shingle_sets(group["text"].tolist(), size), percent)
            out.append(pd.DataFrame({"a": cls, "b": [cls[x] for x in label.tolist()]}))
        return pd.concat(out)

    return run


def _confirm_block(percent: int):
    def run(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        if not len(members) or not len(pivots):
            return pd.DataFrame({"a": [], "b": []})
        m, p = members["cls"].tolist(), pivots["cls"].tolist()
        group = _Group([np.frombuffer(x, np.uint64) for x in pivots["set"].tolist() + members["set"].tolist()])
        pairs = [(p[i], m[j]) for i in range(len(p)) for j in np.flatnonzero(group.linked(i, percent)[len(p) :]).tolist()]
        return pd.DataFrame(pairs, columns=["a", "b"])

    return run


def _against(members: DataFrame, pivots: DataFrame, percent: int) -> DataFrame:
    """Links of each group's members with its pivots.

    A task has about PIVOTS pivots and SHARD members, or fewer where these have more than PIVOT_SHINGLES and SHARD_SHINGLES;
    both sides are dealt by size, and of parts too unlike in size for any link to be none meet.
    """
    keys, parts = ["label", "block", "shard"], []
    for side, most, shingles, name in ((pivots, PIVOTS, PIVOT_SHINGLES, "block"), (members, SHARD, SHARD_SHINGLES, "shard")):
        total = side.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / most), F.ceil(F.sum("n_shingles") / shingles)).alias("parts"))
        # bands of sizes within a factor of two, each dealt over parts in its turn
        band = F.floor(F.log2("n_shingles")).cast("int")
        dealt = side.join(total, "label").withColumn("band", band).withColumn(name, F.pmod(F.xxhash64("cls"), F.col("parts")))
        parts.append(stage(dealt.select("label", "band", name, "cls", "set")))
    p, m = parts
    blocks, shards = p.select("label", "band", "block").distinct(), m.select("label", F.col("band").alias("other"), "shard").distinct()
    # linked sets differ in size by a factor of 100 / percent at most
    reach = math.ceil(math.log2(100 / percent))
    meet = stage(blocks.join(shards, "label").where(F.abs(F.col("band") - F.col("other")) <= reach))
    p = p.join(meet, ["label", "band", "block"]).select(*keys, "band", "other", "cls", "set")
    m = m.withColumnRenamed("band", "other").join(meet, ["label", "other", "shard"]).select(*keys, "band", "other", "cls", "set")
    keys += ["band", "other"]
    return m.groupBy(*keys).cogroup(p.groupBy(*keys)).applyInPandas(_confirm_block(percent), "a binary, b binary")


def _as_sets(size: int):
    def run(batches):
        for b in batches:
            sets = [s.tobytes() for s in shingle_sets(b.column("text").to_pylist(), size)]
            yield pa.record_batch([*(b.column(c) for c in ("label", "cls", "n_shingles")), pa.array(sets, pa.binary())], names=["label", "cls", "n_shingles", "set"])

    return run


def _links_of_crowds(crowds: DataFrame, size: int, percent: int) -> DataFrame:
    """Links of the groups too large for a task; (label, cls, n_shingles, text).

    Texts become sets of hashes once, which is what meets. First all members against a few pivots; then whatever is not in the component
    that is largest now is a pivot itself.
    """
    kind = crowds.schema["label"].dataType.simpleString()
    crowds = stage(crowds.select("label", "cls", "n_shingles", "text").mapInArrow(_as_sets(size), f"label {kind}, cls binary, n_shingles long, set binary"))
    some = crowds.withColumn("lot", F.pmod(F.xxhash64("cls", F.lit(1)), F.lit(GROUP_CLASSES))).where(F.col("lot") < PIVOTS)
    first = stage(_against(crowds, some, percent))
    parts = connected_components(first).withColumnsRenamed({"node": "cls", "label": "part"})
    known = stage(crowds.select("label", "cls").join(parts, "cls", "left").withColumn("part", F.coalesce("part", "cls")))
    sizes = known.groupBy("label", "part").agg(F.count("*").alias("n")).groupBy("label").agg(F.max_by("part", F.struct("n", "part")).alias("largest"))
    outside = known.join(sizes, "label").where("part <> largest").select("cls")
    return first.union(_against(crowds, crowds.join(outside, "cls"), percent))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, th, n_shingles, component_id, kept, part for each row; th is xxhash64 of the text, part names the component.

    Linked are texts whose sets of ``size``-word shingles have at least ``percent`` % in common.
    """
    texts = keyed(docs)
    schema = "doc_id long, th long, n_shingles long, cls binary, sig binary"
    rows = stage(texts.mapInArrow(_describe(size), schema))
    classes = stage(classes_of(rows, F.first("sig").alias("sig")))
    groups = stage(connected_components(suspect_pairs(classes.select("cls", "sig"))).withColumnRenamed("node", "cls"))
    return settled(texts, rows.drop("sig"), classes.drop("sig"), groups, size, percent, _confirm_bucket(size, percent))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, th, text)."""
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("th"), "text")


def classes_of(rows: DataFrame, *more: Column) -> DataFrame:
    """A row for each set of shingles: its first document and how many have it."""
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "th")
    return rows.where("cls is not null").groupBy("cls").agg(F.min(place).alias("least"), F.first("n_shingles").alias("n_shingles"), F.count("*").alias("copies"), *more)


def settled(texts: DataFrame, rows: DataFrame, classes: DataFrame, groups: DataFrame, size: int, percent: int, confirm: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """The links of suspect groups (cls, label and whatever ``confirm`` needs) confirmed on full sets, and each row's component."""
    given = [c for c in groups.columns if c not in ("cls", "label")]
    # the texts of suspect classes only, one row a class
    wanted = classes.join(groups, "cls").select("cls", "label", "n_shingles", *given, F.col("least.doc_id").alias("d"), F.col("least.th").alias("h"))
    wanted = stage(wanted)
    weight = stage(wanted.groupBy("label").agg(F.sum("n_shingles").alias("weight"), F.count("*").alias("members")))
    wanted = stage(spread_join(wanted, weight, ["label"], "members"))
    total = wanted.agg(F.sum("n_shingles")).first()[0] or 0
    suspects = texts.join(wanted.hint("merge"), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("h"))).dropDuplicates(["cls"])
    crowd = (F.col("weight") > GROUP_SHINGLES) | (F.col("members") > GROUP_CLASSES)
    buckets = max(1, -(-total // BUCKET_SHINGLES))
    small = suspects.where(~crowd).select(F.pmod(F.xxhash64("label"), F.lit(buckets)).alias("bucket"), "label", "cls", "text", *given)
    links = small.groupBy("bucket").applyInPandas(confirm, "a binary, b binary")
    if not wanted.where(crowd).isEmpty():
        links = stage(links.union(_links_of_crowds(stage(suspects.where(crowd).select("label", "cls", "n_shingles", "text")), size, percent)))
        links = connected_components(links).toDF("a", "b")
    labels = stage(links.toDF("cls", "part"))
    least = classes.select("cls", F.col("least.doc_id").alias("doc_id"), "copies").join(labels, "cls", "left").withColumn("part", F.coalesce("part", "cls"))
    least = stage(least)
    parts = stage(least.groupBy("part").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n")))
    known = stage(spread_join(least.select("cls", "part", "copies"), parts, ["part"]).select("cls", "component_id", "part", "copies"))
    # copies of one text are many: their class is dealt, too
    worded = spread_join(rows.where("cls is not null"), known, ["cls"], "copies").select("doc_id", "th", "n_shingles", "component_id", "part")
    none = F.lit(None)
    out = worded.unionByName(rows.where("cls is null").select("doc_id", "th", "n_shingles", none.cast("long").alias("component_id"), none.cast("binary").alias("part")))
    out = out.withColumn("component_id", F.coalesce("component_id", "doc_id"))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.select("doc_id", "th", "n_shingles", "component_id", kept.alias("kept"), "part")
