"""Conversation structure repair: the cheapest edits that make a conversation's roles (system?)(user assistant)+ or nothing.

Each row after the damage is kept (0), given another role (1) or deleted (2, and must be where it is blank or a duplicate);
rows of empty text may be inserted (5); a truncated row that stays adds 5. The audit names the edits in order by their initials
(K, R, D, I); of equally cheap audits the ASCII-least is taken.

The audits are found by dynamic programming over the rows and four states (nothing yet, after system, after user, after
assistant). They share their prefixes as linked nodes; each node has its ancestors at distances of powers of two and a rolling hash of its letters.
Two equally cheap audits are compared where they part, which is found by lifting both to one length and searching the longest
common prefix by hash; that the prefixes found equal are equal letter by letter is verified down to their common node.
Of equally cheap audits over the same rows none is a prefix of the other (letters decide the cost), so the lesser stays
the lesser whatever follows.

A conversation of up to ``PIECE`` rows is one piece. A longer one is dealt by ranges of its order into pieces, each of which
is solved from every state it may begin in; then its pieces' tables, and not its rows, meet to choose the way through. What is hashed
at last are pieces, read in order and never held together.

Defined results: null conv_id is a conversation of its own; other nulls are one space, also in the key of the damage; rows are
ordered by turn (nulls first), role and text, so ties and repeated rows have one result; a conversation without rows after the damage has zeros, an
empty audit and the hash of nothing; an empty table gives no rows. Columns other than the four are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage

#: Rows of a conversation that are one piece, as a power of two.
PIECE_BITS = 10
TEXT = r"[^\x20\x09-\x0D]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant. What an emitted initial leads to.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that is wanted next: rerole and insert give user or assistant only.
WANTED = ("u", "u", "a", "u")
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
_BASE, _MOD = 1_000_003, (1 << 61) - 1


class Audits:
    """Strings of edits that share their prefixes: node 0 is empty, every other one is its parent and a letter."""

    def __init__(self):
        self.letter, self.depth, self.hash, self.up = [""], [0], [0], [[0]]

    def extend(self, parent: int, letter: str) -> int:
        node = len(self.letter)
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(letter)) % _MOD)
        ups, k = [parent], 0
        while len(self.up[ups[-1]]) > k and ups[-1]:
            ups.append(self.up[ups[-1]][k])
            k += 1
        self.up.append(ups)
        return node

    def ancestor(self, node: int, depth: int) -> int:
        """The prefix of that length."""
        over = self.depth[node] - depth
        while over:
            k = min(over.bit_length(), len(self.up[node])) - 1
            node, over = self.up[node][k], over - (1 << k)
        return node

    def common(self, a: int, b: int) -> tuple[int, int]:
        """The nodes at the end of the longest prefixes of a and b that are equal."""
        least = min(self.depth[a], self.depth[b])
        a, b = self.ancestor(a, least), self.ancestor(b, least)
        if self.hash[a] != self.hash[b]:
            for k in range(max(len(self.up[a]), len(self.up[b])) - 1, -1, -1):
                if k < len(self.up[a]) and k < len(self.up[b]) and self.hash[self.up[a][k]] != self.hash[self.up[b][k]]:
                    a, b = self.up[a][k], self.up[b][k]
            a, b = self.up[a][0], self.up[b][0]
        x, y, parts = a, b, None
        while x != y:  # equal hashes are verified: a letter that differs above ends the common prefix there
            if self.letter[x] != self.letter[y]:
                parts = (self.up[x][0], self.up[y][0])
            x, y = self.up[x][0], self.up[y][0]
        return parts or (a, b)

    def less(self, a: int, b: int) -> bool:
        """Whether a's string is before b's."""
        pa_, pb = self.common(a, b)
        at = self.depth[pa_]
        if at == min(self.depth[a], self.depth[b]):
            return self.depth[a] < self.depth[b]
        return self.letter[self.ancestor(a, at + 1)] < self.letter[self.ancestor(b, at + 1)]

    def text(self, node: int) -> str:
        out = []
        while node:
            out.append(self.letter[node])
            node = self.up[node][0]
        return "".join(reversed(out))


def solve(rows: list[tuple[str, str]], begin: int, first: bool) -> dict[int, tuple[int, str]]:
    """The cheapest audit to each state that some rows (role initial, fault) can end in, from state ``begin``; ``first``: nothing is before them."""
    paths = Audits()
    best: dict[int, tuple[int, int]] = {begin: (0, 0)}

    def offer(to: dict[int, tuple[int, int]], state: int, cost: int, parent: int, letter: str) -> bool:
        old = to.get(state)
        if old is not None and old[0] < cost:
            return False
        node = paths.extend(parent, letter)
        if old is None or cost < old[0] or paths.less(node, old[1]):
            to[state] = (cost, node)
            return True
        return False

    def inserted() -> None:
        more = True
        while more:
            more = False
            for s in range(4):
                if s in best:
                    more |= offer(best, STEPS[s][WANTED[s]], best[s][0] + INSERT, best[s][1], "I")

    if first:
        inserted()
    for initial, fault in rows:
        now: dict[int, tuple[int, int]] = {}
        for s, (cost, node) in best.items():
            offer(now, s, cost + DELETE, node, "D")
            if fault not in ("blank", "duplicate"):
                extra = cost + (TRUNCATED if fault == "truncated" else 0)
                if initial in STEPS[s]:
                    offer(now, STEPS[s][initial], extra + KEEP, node, "K")
                offer(now, STEPS[s][WANTED[s]], extra + REROLE, node, "R")
        best = now
        inserted()
    return {s: (cost, paths.text(node)) for s, (cost, node) in best.items()}


def replay(rows: list[tuple[str, str]], audit: str, state: int) -> list[tuple[str, str]]:
    """(role, text) of rows after the edits, from a state on."""
    out, at = [], iter(rows)
    for edit in audit:
        role, text = next(at) if edit != "I" else (None, "")
        if edit == "D":
            continue
        step = role[:1] if edit == "K" else WANTED[state]
        out.append((role if edit == "K" else ROLES[step], text))
        state = STEPS[state][step]
    return out


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows with the planted faults; ``gone`` marks the dropped ones."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text, role = space("text"), space("role")
    text = F.when(h == 1, "").when(h == 2, F.translate(text, ".!?", "")).otherwise(text)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.when(h == 4, "user").otherwise(role).alias("role"), text.alias("text"), (h == 0).alias("gone"), F.when(h == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("_", F.explode(F.sequence(F.lit(1), "times"))).drop("_", "times")


def _blank(text: Column) -> Column:
    return ~text.rlike(TEXT)


def _pieces(rows: DataFrame, bits: int) -> DataFrame:
    """(conv_id, turn, role, text, piece, seen, whole): each row with its conversation's piece, and whether an earlier piece has its role and text."""
    sizes = stage(rows.groupBy("conv_id").agg(F.count("*").alias("n")).where(F.col("n") > 1 << bits).withColumnRenamed("conv_id", "c"))
    short = rows.select("conv_id", "turn", "role", "text", F.lit(0).cast("long").alias("piece"), F.lit(False).alias("seen"), F.lit(True).alias("whole"))
    if sizes.isEmpty():
        return short
    of = F.col("conv_id").eqNullSafe(F.col("c"))
    order = ["conv_id", "turn", "role", "text"]
    dealt = rows.join(sizes, of, "left_semi").repartitionByRange(*[F.col(c).asc_nulls_first() for c in order]).sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order])
    dealt = stage(dealt.select(*order, F.shiftright(F.monotonically_increasing_id(), bits).alias("piece"), F.sha2(F.to_json(F.struct("role", "text")), 256).alias("said")))
    # the piece that says it first; a piece gets back no more of these than it has rows
    firsts = stage(dealt.groupBy("conv_id", "said").agg(F.min("piece").alias("first"), F.count_distinct("piece").alias("n")).where("n > 1"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("said").alias("t"), "first")
    later = stage(dealt.select("conv_id", "said", "piece").distinct().join(firsts.hint("merge"), of & (F.col("said") == F.col("t"))).where("piece > first"))
    later = later.select(F.col("piece").alias("p"), F.col("conv_id").alias("c"), F.col("said").alias("t"))
    on = (F.col("piece") == F.col("p")) & of & (F.col("said") == F.col("t"))
    long = dealt.join(later, on, "left").select(*order, "piece", F.col("t").isNotNull().alias("seen"), F.lit(False).alias("whole"))
    return short.join(sizes, of, "left_anti").unionByName(long)


SOLVED = (
    "conv_id {id}, piece long, whole boolean, least_turn long, most_turn long, turns long, blank long, duplicate long, truncated long, illegal long, initials array<string>, "
    "table array<struct<begin:int,end:int,cost:long,audit:string>>, said array<struct<role:string,text:string>>"
)
_TABLE = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_SAID = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _fault(role: str, text: str, seen: bool, said: set) -> str:
    last = text.rstrip(" \t\n\v\f\r")[-1:]
    if not last:
        return "blank"
    if seen or (role, text) in said:
        return "duplicate"
    return "" if last in ".!?" else "truncated"


def _solved_piece(rows: list[dict], conv_id, piece: int, whole: bool) -> dict:
    said, faults = set(), []
    for r in rows:
        faults.append(_fault(r["role"], r["text"], r["seen"], said))
        said.add((r["role"], r["text"]))
    steps = [(r["role"][:1], f) for r, f in zip(rows, faults, strict=True)]
    turns = {r["turn"] for r in rows} - {None}
    table = [{"begin": b, "end": e, "cost": c, "audit": a} for b in ((0,) if whole else range(4)) for e, (c, a) in solve(steps, b, whole).items()]
    pairs = [a[0] + b[0] for a, b in zip(steps, steps[1:])]
    return {
        "conv_id": conv_id, "piece": piece, "whole": whole, "least_turn": min(turns, default=None), "most_turn": max(turns, default=None), "turns": len(turns),
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")}, "illegal": sum(p not in ("su", "ua", "au") for p in pairs), "initials": [steps[0][0], steps[-1][0]],
        "table": table, "said": [{"role": r["role"], "text": r["text"]} for r in rows],
    }


def _solve_pieces(batches: Iterator[pa.RecordBatch]):
    """Rows sorted by conversation, piece and order: a row for each piece."""
    held, key, out, size, schema = [], None, [], 0, None
    for b in batches:
        if schema is None:
            counts = [(c, pa.int64()) for c in ("least_turn", "most_turn", "turns", "blank", "duplicate", "truncated", "illegal")]
            schema = pa.schema([b.schema.field("conv_id"), ("piece", pa.int64()), ("whole", pa.bool_()), *counts, ("initials", pa.list_(pa.string())), ("table", _TABLE), ("said", _SAID)])
        for r in b.to_pylist():
            k = (r["conv_id"], r["piece"], r["whole"])
            if held and k != key:
                out.append(_solved_piece(held, *key))
                size += sum(len(x["text"]) for x in held)
                held = []
                if size > 1 << 22:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out, size = [], 0
            key = k
            held.append(r)
    if held:
        yield pa.RecordBatch.from_pylist([*out, _solved_piece(held, *key)], schema)


def _choose(tables: list[tuple[int, list[dict]]]) -> tuple[int, list[tuple[int, int, str]]]:
    """Through the tables of a conversation's pieces in order: the least cost and (piece, begin, audit) of each piece."""
    best: dict[int, tuple[int, tuple | None]] = {0: (0, None)}

    def tail(a, b) -> tuple[str, str]:
        """What two chains of pieces say since they parted."""
        x, y = [], []
        while a is not b:
            x.append(a[3])
            y.append(b[3])
            a, b = a[0], b[0]
        return "".join(reversed(x)), "".join(reversed(y))

    for i, (piece, table) in enumerate(tables):
        now: dict[int, tuple[int, tuple]] = {}
        if i == 0:  # what may be inserted before the first row
            start = {s: (c, (None, -1, 0, a)) for s, (c, a) in solve([], 0, True).items() if s}
            best |= start
            best[0] = (0, (None, -1, 0, ""))
        for t in table:
            if t["begin"] not in best:
                continue
            cost, chain = best[t["begin"]]
            new = (cost + t["cost"], (chain, piece, t["begin"], t["audit"]))
            old = now.get(t["end"])
            if old is None or new[0] < old[0] or new[0] == old[0] and (lambda x: x[0] < x[1])(tail(new[1], old[1])):
                now[t["end"]] = new
        best = now
    found = [best[e] for e in ENDS if e in best]
    cost, chain = found[0]
    for c, other in found[1:]:
        if c < cost or c == cost and (lambda x: x[0] < x[1])(tail(other, chain)):
            cost, chain = c, other
    out = []
    while chain is not None:
        out.append(chain[1:])
        chain = chain[0]
    return cost, out[::-1]


def _chosen(table: pa.Table) -> pa.Table:
    """A conversation's tables to what is chosen for each piece; before the first piece stands piece -1."""
    schema = pa.schema([table.schema.field("conv_id"), ("piece", pa.int64()), ("begin", pa.int32()), ("audit", pa.string()), ("cost", pa.int64())])
    rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
    cost, ways = _choose([(r["piece"], r["table"]) for r in rows])
    return pa.Table.from_pylist([{"conv_id": rows[0]["conv_id"], "piece": p, "begin": b, "audit": a, "cost": cost if p == -1 else 0} for p, b, a in ways], schema)


def _repaired(batches: Iterator[pa.RecordBatch]):
    """(..., repaired) of pieces with the audit chosen."""
    for b in batches:
        rows = zip(b.column("said").to_pylist(), b.column("audit").to_pylist(), b.column("begin").to_pylist(), strict=True)
        out = [[{"role": r, "text": t} for r, t in replay([(x["role"], x["text"]) for x in said or []], audit, begin)] for said, audit, begin in rows]
        keep = [c for c in b.schema.names if c != "said"]
        yield pa.record_batch([*(b.column(c) for c in keep), pa.array(out, _SAID)], names=[*keep, "repaired"])


def repair(conversations: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """Pieces of conversations (conv_id, turn, role, text) with their statistics, edits and repaired turns.

    conv_id, piece, least_turn, most_turn, turns, blank, duplicate, truncated, illegal, initials (first and last), begin, audit, cost, repaired (role, text).
    Pieces are numbered in order; a conversation of more than one piece has one more, -1, with what is inserted before its first row and its whole cost.
    """
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    kind = conversations.schema["conv_id"].dataType.simpleString()
    ordered = _pieces(rows, bits).repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", F.col("turn").asc_nulls_first(), "role", "text")
    solved = stage(ordered.mapInArrow(_solve_pieces, SOLVED.format(id=kind)))
    # a whole conversation ends where a way through may end
    end = F.filter("table", lambda t: t["end"].isin(*ENDS))
    least = F.array_sort(F.transform(end, lambda t: F.struct(t["cost"].alias("cost"), t["audit"].alias("audit"))))[0]
    rest = ["least_turn", "most_turn", "turns", "blank", "duplicate", "truncated", "illegal", "initials"]
    done = solved.where("whole").withColumn("t", least).select("conv_id", "piece", *rest, F.lit(0).alias("begin"), "t.audit", "t.cost", "said")
    parted = solved.where("not whole")
    if not parted.isEmpty():
        ways = parted.select("conv_id", "piece", "table").groupBy("conv_id").applyInArrow(_chosen, f"conv_id {kind}, piece long, begin int, audit string, cost long")
        ways = stage(ways).withColumnsRenamed({"conv_id": "c", "piece": "p"})
        on = F.col("c").eqNullSafe(F.col("conv_id")) & (F.col("p") == F.col("piece"))
        met = ways.join(parted.drop("whole", "table"), on, "left")
        done = done.unionByName(met.select(F.col("c").alias("conv_id"), F.col("p").alias("piece"), *rest, "begin", "audit", "cost", "said"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in done.schema.fields if f.name != "said")
    return done.mapInArrow(_repaired, f"{fields}, repaired array<struct<role:string,text:string>>")


def _hashed(batches: Iterator[pa.RecordBatch]):
    """Pieces sorted by conversation and number: a row for each conversation, its turns hashed as they come."""
    key, digest, audit, begun, schema = None, None, [], False, None

    def ended() -> dict:
        return {"conv_id": key[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

    for b in batches:
        out, schema = [], pa.schema([b.schema.field("conv_id"), ("audit", pa.string()), ("repaired_sha256", pa.string())])
        for conv_id, part, said in zip(*(b.column(c).to_pylist() for c in ("conv_id", "audit", "said")), strict=True):
            if key is None or key[0] != conv_id:
                if key is not None:
                    out.append(ended())
                key, digest, audit, begun = (conv_id,), hashlib.sha256(), [], False
            audit.append(part)
            if said is not None:
                digest.update((("\n" if begun else "") + said).encode())
                begun = True
        yield pa.RecordBatch.from_pylist(out, schema)
    if key:
        yield pa.RecordBatch.from_pylist([ended()], schema)


def report(pieces: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of the pieces of ``repair``."""
    pieces = stage(pieces)
    along = Window.partitionBy("conv_id").orderBy("piece")
    before = F.lag(F.struct("most_turn", "initials")).over(along)
    counts = pieces.where("initials is not null").select("conv_id", "piece", "least_turn", "most_turn", "turns", "blank", "duplicate", "truncated", "illegal", "initials").withColumn("before", before)
    seam = F.concat(F.col("before.initials")[1], F.col("initials")[0])
    # a turn that goes on from one piece to the next counts once
    counts = counts.withColumns(
        {"turns": F.col("turns") - F.coalesce((F.col("before.most_turn") == F.col("least_turn")).cast("int"), F.lit(0)), "illegal": F.col("illegal") + F.coalesce((~seam.isin("su", "ua", "au")).cast("int"), F.lit(0))}
    )
    sums = counts.groupBy("conv_id").agg(
        F.coalesce(F.max("most_turn") - F.min("least_turn") + 1 - F.sum("turns"), F.lit(0)).cast("long").alias("gaps"), *(F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal"))
    )
    said = F.when(F.size("repaired") > 0, F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n"))
    ordered = pieces.select("conv_id", "piece", "audit", said.alias("said")).repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    hashed = ordered.mapInArrow(_hashed, f"conv_id {pieces.schema['conv_id'].dataType.simpleString()}, audit string, repaired_sha256 string")
    costs = pieces.groupBy("conv_id").agg(F.sum("cost").cast("long").alias("cost"))
    for other in (hashed, costs):
        other = other.withColumnRenamed("conv_id", "c")
        sums = sums.join(other, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    return sums.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def audit_report(conversations: DataFrame, bits: int = PIECE_BITS) -> DataFrame:
    """``report`` of the damaged conversations, and a row for each that the damage has left without rows."""
    rows = stage(damaged(conversations))
    out = report(repair(rows.where("not gone").drop("gone"), bits))
    zero, empty = F.lit(0).cast("long"), hashlib.sha256().hexdigest()
    bare = rows.groupBy("conv_id").agg(F.min("gone").alias("bare")).where("bare").select("conv_id", *(zero.alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.lit("").alias("audit"), F.lit(empty).alias("repaired_sha256"))
    return out.unionByName(bare)
