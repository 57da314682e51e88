"""Conversation repair and spelling variants against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from graphloom.llm import conversations as C
from graphloom.llm import spelling as S

ROWS = "conv_id long, turn long, role string, text string, c string, piece string, seen string"


def planted(rows):
    """Rows after the damage, by plain Python."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def brute(rows):
    """Every audit of a few rows: the least (cost, audit) and what it leaves."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        said = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for edits in itertools.product("KRD", repeat=len(rows)):
        if any(e != "D" and f in ("blank", "duplicate") for e, f in zip(edits, faults)):
            continue
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            if sum(gaps) > 4:
                continue
            audit = "".join("I" * g + e for g, e in zip(gaps, [*edits, ""]))
            cost = sum({"K": 0, "R": 1, "D": 2}[e] + (5 if e != "D" and f == "truncated" else 0) for e, f in zip(edits, faults)) + 5 * sum(gaps)
            if best is not None and (cost, audit) >= best[:2]:
                continue
            at, out, ok = iter(rows), [], True
            for e in audit:
                r = next(at) if e != "I" else None
                want = "a" if out and out[-1][0][:1] == "u" else "u"
                if e == "K":
                    ok &= r[2][:1] == want or not out and r[2][:1] == "s"
                    out.append((r[2], r[3]))
                elif e != "D":
                    out.append(({"u": "user", "a": "assistant"}[want], r[3] if r else ""))
            if ok and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in out)):
                best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in out))
    turns = {r[1] for r in rows} - {None}
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), sum(p not in ("su", "ua", "au") for p in pairs),
        best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest(),
    )


def talks(n=60, seed=5):
    rng, rows = random.Random(seed), []
    for conv in range(n):
        for turn in range(rng.randrange(1, 6)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, rng.choice(["Yes.", "No!", "cut off", "é?", "", " \t", None, "So. "])))
    return rows + [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yo.")]


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("bits", [10, 1])
def test_repair_equals_brute_force_whole_and_in_pieces(spark, bits):
    rows = talks()
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in C.audit_report(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], ROWS), bits).collect()}
    want = {conv: brute(planted([r for r in rows if r[0] == conv])) for conv in {r[0] for r in rows}}
    assert got == want


def test_long_conversations_have_one_result_in_any_pieces(spark):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", "tool"]
    rows = [(1, t // 2, rng.choice(roles), rng.choice(["a.", "b", "c!", "d", f"{t}.", ""]), "x", "y", "z") for t in range(700)]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    whole, parts = (C.audit_report(df, b).collect() for b in (12, 5))
    assert whole == parts and len(whole) == 1 and whole[0]["cost"] > 0


def test_empty_and_dropped(spark):
    none = spark.createDataFrame([], ROWS)
    assert C.audit_report(none).collect() == []
    gone = next(c for c in range(99) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    (row,) = C.audit_report(spark.createDataFrame([(gone, 0, "user", "a.", "", "", "")], ROWS)).collect()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


@pytest.mark.parametrize("base", [C._BASE, 0])
def test_audits_compare_as_their_strings_even_if_hashes_collide(monkeypatch, base):
    """With base 0 a hash is the last letter alone, so almost all prefixes collide."""
    monkeypatch.setattr(C, "_BASE", base)
    rng, paths = random.Random(1), C.Audits()
    nodes = [0]
    for _ in range(400):
        nodes.append(paths.extend(rng.choice(nodes[-30:]), rng.choice("DIKR")))
    for _ in range(2000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert paths.less(a, b) == (paths.text(a) < paths.text(b))


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(words):
    out = {}
    for w, n in words.items():
        found = [x for x in words if near(w, x)]
        best = min(found, key=lambda x: (-words[x], x), default=None)
        out[w] = (best if best and words[best] >= 2 * n else None, n, len(found))
    rows = {}
    for w, (form, n, k) in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        rows[w] = (form, root, n, k, words[form] if form else None)
    return rows


@pytest.mark.parametrize("hot", [256, 0, 2])
def test_variants_equal_brute_force_with_and_without_hot_grams(spark, hot):
    rng = random.Random(hot)
    words = {}
    for _ in range(60):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(5, 9)))
        words[w] = rng.randrange(3, 40)
        for _ in range(6):
            i, c = rng.randrange(len(w)), rng.choice("abéz")
            x = rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])
            if len(x) >= 5:
                words.setdefault(x, rng.randrange(3, 40))
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r["word"]: tuple(r)[1:] for r in S.variants(df, hot=hot).collect()}
    assert got == brute_variants(words)


def test_damaged_words_are_those_of_plain_python(spark):
    rows = [(i, t) for i, t in enumerate(["Straße ÄPFEL over-Reach x", None, "", "a1b×÷ÿé", "same Same SAME"] * 40)] + [(None, "alone words stay")]
    want = []
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            want.append(low[: h % len(low)] + low[h % len(low) + 1 :] if h % 97 == 0 else low)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, word string")
    assert sorted(r[0] for r in S.damaged_words(df).collect()) == sorted(want)
    assert S.variants(S.counted(S.damaged_words(df.limit(0)))).collect() == []
    n = {r["word"]: r["n"] for r in S.counted(S.damaged_words(df)).collect()}
    assert all(len(w) >= 5 and c >= 3 for w, c in n.items()) and n["straße"] == want.count("straße")
    assert S.damaged_words(df).agg(F.count("*")).first()[0] == len(want)
