"""Toxicity with noisy-channel deobfuscation.

A character trigram model is counted over all texts. A token that may hide a word
(digits or signs for letters, signs between letters, letters said three times or more, or a word
spelled with white space, its letters disguised or not) becomes a lattice of what each character may stand for, and the
Viterbi path under channel and model is the restored word. A word with a letter said twice is taken as it is and with it
said once. Scores come from the restored words and the runs of letters that a disguised token shows openly:
a list of terms (words and word beginnings) whose presence
means a toxic document, learned by greedy covering from labelled rows.

Labels are learned only from rows whose crc32(doc_id) mod 5 is not 0, and from at most about ``FIT_ROWS``
of these, chosen by hash; near copies among them count once. Nothing but the text enters a score.

Defined results: null and empty texts match no term and get the score of such documents;
a null doc_id counts as held out; without toxic labels nothing is learned and every
score is 0; a document labelled twice is toxic if one label says so; an empty table stays empty; other
columns are carried, whatever their names, but for ``_score`` or ``_restored``, which the result replaces.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import stage
from .words import shingle_sets

FIT_ROWS = 40_000
MIN_DOCS = 5
LETTERS = 28  # 0: no letter, 1 to 26: a to z, 27: any other
THRESHOLD = 0.5
#: Least worth of a term: Wilson's lower bound of the share of toxic documents among those that hold it.
LEAST_WORTH = 0.65
#: A term of this worth, found in this share of the toxic documents and in at most this share of others, needs no more.
SURE, FREQUENT, IMPURE = 0.9, 0.02, 0.01
#: Candidate terms of a document up to which each gets its whole vote.
SHARED = 12

# fixed values: what a sign may stand for
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "µ": "u", "¡": "i",
}
#: Signs put between letters.
BETWEEN = ".-_*~'`^/\\,:;·•"
#: Log-probabilities of the channel: a sign for a letter, a sign put in, a letter repeated.
SIGN, PUT_IN, REPEATED = math.log(0.05), math.log(0.1), math.log(0.2)

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = ".,;:?!\"'()[]{}<>«»“”„…-*_"
#: Single characters with up to three blanks or line ends between.
_SPELLED = re.compile(r"(?:(?<=\s)|^)(?:\S\s{1,3}){2,}\S(?=\s|$)")
_BLANK = re.compile(r"\s+")
_LONG_RUN = re.compile(r"(.)\1\1")
_DOUBLED = re.compile(r"(.)\1")
_PART = re.compile(r"[^\W\d_]{2,}")


def _letter(c: str) -> int:
    base = unicodedata.normalize("NFD", c)[0]
    return ord(base) - 96 if "a" <= base <= "z" else 27 if c.isalpha() else 0


_IDS = np.array([_letter(chr(i).lower()[:1]) for i in range(0x2000)], np.int32)


def letter_ids(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return np.where(code < len(_IDS), _IDS[np.minimum(code, len(_IDS) - 1)], 27)


def _count_trigrams(batches):
    total = np.zeros(LETTERS**3, np.int64)
    for batch in batches:
        texts = [t for t in batch.column("text").to_pylist() if t]
        for i in range(0, len(texts), 200):
            x = letter_ids("\n" + "\n".join(texts[i : i + 200]) + "\n")
            total += np.bincount((x[:-2] * LETTERS + x[1:-1]) * LETTERS + x[2:], minlength=LETTERS**3)
    seen = np.flatnonzero(total)
    yield pa.record_batch([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], names=["gram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log-probability of the third letter after two, (28, 28, 28), from every text; a table of fixed size."""
    rows = docs.select("text").mapInArrow(_count_trigrams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LETTERS**3)
    for r in rows:
        counts[r["gram"]] = r["n"]
    tri = counts.reshape(LETTERS, LETTERS, LETTERS)
    bi = tri.sum(axis=0)
    backed = (bi + 0.5) / (bi + 0.5).sum(axis=1, keepdims=True)
    return np.log((tri + 20 * backed[None]) / (tri.sum(axis=2, keepdims=True) + 20)).astype(np.float32)


def _choices(chars: str) -> list[list[tuple[str, float]]]:
    """For each character the strings it may stand for, with the channel's log-probability."""
    out: list[list[tuple[str, float]]] = []
    for i, c in enumerate(chars):
        if c.isalpha():
            options = [(c, 0.0)]
            if i and chars[i - 1] == c:
                options.append(("", REPEATED))
        elif c in STANDS_FOR:
            options = [(s, SIGN) for s in STANDS_FOR[c]]
            if i and chars[i - 1] == c:
                options.append(("", REPEATED))
            if c in BETWEEN or c == "!":
                options.append(("", PUT_IN))
        else:
            options = [("", PUT_IN)]
        out.append(options)
    return out


def decode(chars: str, model: np.ndarray) -> tuple[str, float]:
    """The most likely word behind ``chars`` and its log-probability. The lattice's states are the last two letters."""
    states: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
    for options in _choices(chars):
        grown: dict[tuple[int, int], tuple[float, str]] = {}
        for (a, b), (score, word) in states.items():
            for s, cost in options:
                if s:
                    c = _letter(s)
                    key, new = (b, c), (score + cost + float(model[a, b, c]), word + s)
                else:
                    key, new = (a, b), (score + cost, word)
                if key not in grown or new[0] > grown[key][0]:
                    grown[key] = new
        states = grown
    return max(((word, score + float(model[a, b, 0])) for (a, b), (score, word) in states.items()), key=lambda x: x[1])


class Restorer:
    """Tokens of a text, restored; remembers what it has decoded."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def words(self, token: str) -> tuple[str, ...]:
        """The lower-case words a token stands for."""
        got = self.known.get(token)
        if got is None:
            if len(self.known) > 500_000:
                self.known.clear()
            got = self.known[token] = self._words(token)
        return got

    def _words(self, token: str) -> tuple[str, ...]:
        core = token.strip(_EDGES)
        if core.isalpha():
            if _LONG_RUN.search(core):
                return decode(core, self.model)[0], core
            once = _DOUBLED.sub(r"\1", core)
            return (core,) if once == core else (core, once)
        parts = tuple(_PART.findall(core))
        letters, signs = sum(c.isalpha() for c in core), sum(c in STANDS_FOR for c in core)
        if core.isdigit() or not (letters >= 2 or letters and signs or signs >= 3):
            return parts
        return (decode(core, self.model)[0], *parts)

    def spelled(self, run: str) -> str | None:
        """The word behind characters with blanks between, if it is likelier than the characters alone."""
        letters = _BLANK.sub("", run)
        plain = sum(c.isalpha() for c in letters)
        if not plain or plain * 2 < len(letters) and not all(c.isalpha() or c in STANDS_FOR for c in letters):
            return None
        word, score = decode(letters, self.model)
        lone = lambda c: float(self.model[0, 0, _letter(c)] + self.model[0, _letter(c), 0])
        apart = sum(lone(c) if c.isalpha() else max(map(lone, STANDS_FOR.get(c, "")), default=0.0) for c in letters)
        return word if score > apart else None

    def terms(self, text: str | None) -> set[str]:
        """The distinct restored words of a text."""
        if not text:
            return set()
        text = text.lower()
        found: set[str] = set()
        for m in _SPELLED.finditer(text):
            word = self.spelled(m[0])
            if word:
                found.add(word)
        for token in set(_TOKEN.findall(text)):
            found.update(self.words(token))
        return found

    def restored(self, text: str | None) -> str | None:
        """The text with each token replaced by the word it stands for."""
        if not text:
            return text
        text = _SPELLED.sub(lambda m: self.spelled(m[0].lower()) or m[0], text)
        return _TOKEN.sub(lambda m: m[0] if m[0].strip(_EDGES).isalpha() and not _LONG_RUN.search(m[0]) else next(iter(self.words(m[0].lower())), m[0]), text)


def features(word: str) -> Iterable[str]:
    """A word itself, and its beginnings of four to six letters."""
    yield f"={word}"
    for n in (4, 5, 6):
        if len(word) > n:
            yield word[:n]


def _bucket(feature: str) -> int:
    """A term's name: 63 bits of its hash."""
    return xxhash.xxh3_64_intdigest(feature) >> 1


def _buckets(restorer: Restorer, known: dict[str, tuple[int, ...]], text: str | None) -> np.ndarray:
    out: list[int] = []
    for w in restorer.terms(text):
        got = known.get(w)
        if got is None:
            if len(known) > 500_000:
                known.clear()
            got = known[w] = tuple(map(_bucket, features(w)))
        out += got
    return np.unique(np.array(out, np.int64))


def _sketches(batches):
    for batch in batches:
        sets = shingle_sets(batch.column("text").to_pylist(), 4)
        sketch = [int(s[0]) >> 1 if len(s) else 0 for s in sets]
        yield pa.record_batch([*batch.columns, pa.array(sketch, pa.int64())], names=[*batch.schema.names, "sketch"])


def _count_terms(model: np.ndarray, only: np.ndarray | None):
    """How many texts hold each term (of ``only``, if given), added up for some texts at a time."""

    def run(batches):
        restorer, known = Restorer(model), {}
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for i in range(0, len(texts), 1000):
                found = np.concatenate([_buckets(restorer, known, t) for t in texts[i : i + 1000]])
                terms, n = np.unique(found if only is None else found[np.isin(found, only)], return_counts=True)
                yield pa.record_batch([pa.array(terms, pa.int64()), pa.array(n, pa.int64())], names=["bucket", "n"])

    return run


def _incidence(model: np.ndarray, only: np.ndarray):
    def run(batches):
        restorer, known = Restorer(model), {}
        for batch in batches:
            rows = [np.intersect1d(_buckets(restorer, known, t), only) for t in batch.column("text").to_pylist()]
            sketch = np.repeat(batch.column("sketch").to_numpy(), [len(r) for r in rows])
            yield pa.record_batch([pa.array(sketch, pa.int64()), pa.array(np.concatenate([*rows, np.empty(0, np.int64)]), pa.int64())], names=["doc", "bucket"])

    return run


def lower_bound(hits: float, n: float, z: float = 2.0) -> float:
    """Wilson's lower bound of a share."""
    p = hits / n
    return (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def cover(pairs: Iterable[tuple[int, int]], worth: dict[int, float], documents: int, pure: set[int] | None = None) -> tuple[dict[int, float], int]:
    """Greedily the terms that cover most documents not covered yet; and how many stay uncovered.

    A document that holds many candidates says little about each, as copies of one text
    share all their rare words; above ``SHARED`` candidates its vote is split. A pure term
    (of ``pure``, all if not given) that is both frequent and sure stands on its own, however few documents need it.
    """
    pairs = list(pairs)
    held = Counter(doc for doc, _ in pairs)
    vote = {doc: min(1.0, SHARED / n) for doc, n in held.items()}
    holds = defaultdict(set)
    for doc, bucket in pairs:
        holds[bucket].add(doc)
    votes = lambda docs: sum(map(vote.__getitem__, docs))
    chosen = {b: worth[b] for b, d in holds.items() if worth[b] >= SURE and (pure is None or b in pure) and votes(d) >= documents * FREQUENT}
    covered = {doc for b in chosen for doc in holds.pop(b)}
    holds = {b: left for b, d in holds.items() if (left := d - covered)}
    least = max(3, documents // 500)
    while holds:
        gain = {b: votes(d) * worth[b] for b, d in holds.items()}
        best = min(gain, key=lambda b: (-gain[b], b))
        if votes(holds[best]) < least:
            break
        chosen[best] = worth[best]
        new = holds.pop(best)
        covered |= new
        holds = {b: left for b, d in holds.items() if (left := d - new)}
    return chosen, documents - len(covered)


class Model:
    """What scoring needs: the character model, the chosen terms' worth, and the score without a term."""

    def __init__(self, characters: np.ndarray, terms: dict[int, float], base: float):
        self.characters, self.terms, self.base = characters, terms, base


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(5))


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learns from documents whose id has a label ``toxic`` and is not held out."""
    characters = character_model(docs)
    said = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    said = said.where(fold(F.col("doc_id")) != 0)
    n = said.count()
    share = min(1.0, fit_rows / max(1, n))
    picked = said.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about fit_rows rows of two numbers, whatever the number of labels
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked.select(F.col("doc_id").cast("long"), "toxic")), "doc_id").select("text", "toxic")
    rows = stage(rows.mapInArrow(_sketches, "text string, toxic int, sketch long").dropDuplicates(["sketch", "toxic"]))
    toxic = rows.where("toxic = 1").select("text", "sketch")
    n_toxic, n_rows = toxic.count(), rows.count()
    if not n_toxic:
        return Model(characters, {}, 0.0)
    count = lambda df, only: df.select("text").mapInArrow(_count_terms(characters, only), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    hits = {r["bucket"]: r["n"] for r in count(toxic, None).where(F.col("n") >= MIN_DOCS).collect()}
    every = count(rows, np.array(sorted(hits), np.int64))
    seen = {r["bucket"]: r["n"] for r in every.collect()}
    worth = {b: w for b, n in seen.items() if (w := lower_bound(hits[b], n)) >= LEAST_WORTH}
    pure = {b for b in worth if hits[b] >= (1 - IMPURE) * seen[b]}
    pairs = toxic.mapInArrow(_incidence(characters, np.array(sorted(worth), np.int64)), "doc long, bucket long").distinct().collect()
    terms, left = cover(((r["doc"], r["bucket"]) for r in pairs), worth, n_toxic, pure)
    return Model(characters, terms, min(0.49, left / max(1, n_rows - n_toxic + left)))


def _score(model: Model):
    def run(batches):
        restorer = Restorer(model.characters)
        known: dict[str, float] = {}

        def worth(word: str) -> float:
            w = known.get(word)
            if w is None:
                if len(known) > 500_000:
                    known.clear()
                w = known[word] = max((model.terms.get(_bucket(f), 0.0) for f in features(word)), default=0.0)
            return w

        for batch in batches:
            scores = []
            for text in batch.column("text").to_pylist():
                doubt = 1.0
                for w in map(worth, restorer.terms(text)):
                    if w:
                        doubt *= 1 - w
                scores.append(max(model.base, 1 - doubt))
            yield pa.record_batch([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "_score"])

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_score``: 0 to 1, higher where toxicity is likelier."""
    docs = docs.drop("_score")
    return docs.mapInArrow(_score(model), StructType([*docs.schema.fields]).add("_score", "double"))


def restore(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """``docs`` with ``_restored``, the text as the channel decodes it."""
    docs = docs.drop("_restored")

    def run(batches):
        restorer = Restorer(model)
        for batch in batches:
            texts = [restorer.restored(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, "_restored"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add("_restored", "string"))
