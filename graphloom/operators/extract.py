"""Entity and relation extraction from chunks through pluggable extractors.

An extractor is any object with ``entities(text) -> str`` and ``relations(text, entities) -> str``, both
JSON arrays as a language model answers them. Calls run in tasks, so the number of
partitions is the number of callers; a chunk whose calls fail gives nothing.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import replace
from typing import Protocol

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .retry import POLICIES, Caller, SharedWait

# fixed values: entity types, in default order
ENTITY_TYPES = [
    "CƠ_QUAN_BAN_HÀNH", "VĂN_BẢN_PHÁP_LUẬT", "LOẠI_THUẾ_PHÍ", "MỨC_THU_PHÍ", "ĐỐI_TƯỢNG_ÁP_DỤNG",
    "HOẠT_ĐỘNG_ĐƯỢC_ĐIỀU_CHỈNH", "ĐIỀU_KHOẢN", "THỜI_HẠN_HIỆU_LỰC",
]
# fixed values: relation labels
RELATIONS = [
    "ban_hành_bởi", "căn_cứ", "sửa_đổi_bổ_sung", "quy_định_mức", "áp_dụng_cho", "điều_chỉnh", "thu_bởi",
    "nộp_vào", "có_hiệu_lực_từ", "thay_thế", "hướng_dẫn_thi_hành", "bao_gồm", "liên_quan",
]
UNKNOWN, DEFAULT_RELATION, KEYWORD = "UNKNOWN", "liên_quan", "TERM_YAKE"
TEXT_LIMIT = {"nim": 3500, "gpt": 6000}

ENTITY = "struct<name:string,type:string,description:string>"
RELATION = "struct<source:string,target:string,relation:string,description:string,weight:string>"


class Extractor(Protocol):
    def entities(self, text: str) -> str: ...

    def relations(self, text: str, entities: list[dict]) -> str: ...


def entity_prompt(content: Column, types: Sequence[str] = ENTITY_TYPES, limit: int = 6000) -> Column:
    head = f"List every entity of the legal text below as a JSON array of objects with name, type and description. Types: {', '.join(types)}.\n\nTEXT:\n"
    return F.concat(F.lit(head), F.substring(content, 1, limit))


def relation_prompt(content: Column, entities: Column, limit: int = 6000) -> Column:
    """entities: array of structs with name and type."""
    head = f"Relate the entities to each other as the text says, as a JSON array of objects with source, target, relation, description and weight. Relations: {', '.join(RELATIONS)}.\n\nENTITIES:\n"
    shown = F.to_json(F.transform(entities, lambda e: F.struct(e["name"].alias("name"), e["type"].alias("type"))))
    return F.concat(F.lit(head), shown, F.lit("\n\nTEXT:\n"), F.substring(content, 1, limit))


def with_retry(call: Callable[[], str], attempts: int = 5, wait: float = 1.0, most: float = 30.0, sleep: Callable[[float], None] = time.sleep) -> str:
    """The call's answer; failed attempts wait twice as long each time; empty after the last."""
    for i in range(attempts):
        try:
            return call()
        except Exception:  # noqa: BLE001 - any failure of an external service counts as an attempt
            if i + 1 < attempts:
                sleep(min(wait * 2**i, most))
    return ""


def known_entities(answer: str | None) -> list[dict]:
    """The objects of an answer's first-to-last bracket span, as ``json_objects`` takes them; nothing if that is no array."""
    first, last = (answer or "").find("["), (answer or "").rfind("]")
    try:
        found = json.loads(answer[first : last + 1]) if 0 <= first < last else []
    except (ValueError, RecursionError):
        return []
    return [e for e in found if isinstance(e, dict)] if isinstance(found, list) else []


def call_extractor(chunks: DataFrame, make: Callable[[], Extractor], workers: int | None = None, limit: int = 6000, attempts: int = 5, wait: float = 1.0, backend: str = "nim") -> DataFrame:
    """(chunk_idx, entities_json, relations_json) of (chunk_idx, content) and, if there, ``keywords``, an array of names.

    ``make`` runs once a task, calls are repeated as ``backend``'s policy says (``wait`` is its unit), and the callers of a machine share its wait; relations are asked for between the entities found and the keywords that are none of
    them, and only where there are any.
    """
    policy = replace(POLICIES.get(backend, POLICIES["nim"]), attempts=attempts, unit=wait)
    application = chunks.sparkSession.sparkContext.applicationId

    def run(batches: Iterator[pa.RecordBatch]):
        extractor, caller = make(), Caller(policy, SharedWait(application))
        for b in batches:
            found, related = [], []
            extra = b.column("keywords").to_pylist() if "keywords" in b.schema.names else [None] * b.num_rows
            for text, names in zip(b.column("content").to_pylist(), extra):
                cut = (text or "")[:limit]
                found.append(caller.call(lambda cut=cut: extractor.entities(cut)))
                known = known_entities(found[-1])
                named = {str(e.get("name") or "").strip().upper() for e in known}
                known += [{"name": n, "type": KEYWORD} for n in names or [] if n not in named]
                related.append(caller.call(lambda cut=cut, known=known: extractor.relations(cut, known)) if known else "[]")
            yield pa.record_batch([b.column("chunk_idx"), pa.array(found, pa.string()), pa.array(related, pa.string())], names=["chunk_idx", "entities_json", "relations_json"])

    dealt = chunks.repartition(workers) if workers else chunks
    return dealt.select(F.col("chunk_idx").cast("long"), "content", *[c for c in chunks.columns if c == "keywords"]).mapInArrow(run, "chunk_idx long, entities_json string, relations_json string")


def parse_entities(answers: DataFrame, column: str = "entities_json") -> DataFrame:
    """(chunk_idx, pos, name, type, description) of JSON answers; no name, no row."""
    rows = answers.select("chunk_idx", F.posexplode(T.json_objects(F.col(column))).alias("pos", "o")).withColumn("o", F.from_json("o", ENTITY))
    name = T.entity_name(F.col("o.name"))
    return rows.select("chunk_idx", "pos", name.alias("name"), F.coalesce("o.type", F.lit(UNKNOWN)).alias("type"), F.coalesce("o.description", F.lit("")).alias("description")).where("name <> ''")


def parse_relations(answers: DataFrame, column: str = "relations_json") -> DataFrame:
    """(chunk_idx, pos, source, target, relation, description, weight) of JSON answers."""
    rows = answers.select("chunk_idx", F.posexplode(T.json_objects(F.col(column))).alias("pos", "o")).withColumn("o", F.from_json("o", RELATION))
    return rows.select(
        "chunk_idx", "pos", T.entity_name(F.col("o.source")).alias("source"), T.entity_name(F.col("o.target")).alias("target"),
        F.coalesce("o.relation", F.lit(DEFAULT_RELATION)).alias("relation"), F.coalesce("o.description", F.lit("")).alias("description"), T.weight(F.col("o.weight")).alias("weight"),
    )


def rule_entities(chunks: DataFrame, types: Sequence[str] = ENTITY_TYPES) -> DataFrame:
    """The offline extractor: capitalised words of seven ASCII letters or more, typed by length and place."""
    words = F.regexp_extract_all("content", F.lit("[A-Z][a-z]{6,}"), 0)
    rows = chunks.select("chunk_idx", F.posexplode(words).alias("pos", "word"))
    kind = F.element_at(F.array(*map(F.lit, types)), ((F.length("word") + F.col("pos")) % len(types) + 1).cast("int"))
    return rows.select("chunk_idx", "pos", F.upper("word").alias("name"), kind.alias("type"), F.concat(F.lit("word "), F.col("pos") % 5).alias("description"))


def rule_relations(entities: DataFrame) -> DataFrame:
    """Neighbouring entities of a chunk, related by place."""
    w = Window.partitionBy("chunk_idx").orderBy("pos")
    rows = entities.select("chunk_idx", "pos", F.col("name").alias("source"), F.lead("name").over(w).alias("target")).where("target is not null")
    label = F.element_at(F.array(*map(F.lit, RELATIONS)), (F.col("pos") % len(RELATIONS) + 1).cast("int"))
    return rows.select(
        "chunk_idx", "pos", "source", "target", label.alias("relation"), F.concat(F.lit("at "), F.col("pos") % 3).alias("description"),
        F.greatest(F.lit(0.1), F.least(F.lit(1.0), (F.col("pos") % 12) / 10)).alias("weight"),
    )


def keywords(chunks: DataFrame, k: int = 5, least: int = 3, words: int = 1, alike: float = 0.9) -> DataFrame:
    """Up to k keywords a chunk, without a model: words scored by frequency, spread over sentences and first place.

    A simple form of the published feature-based keyword scores; lower is better. Phrases of up to ``words`` neighbouring
    words of ``least`` letters score the product of their words' scores over frequency and sum; of two
    that are ``alike`` or more (1 - edit distance / longer length) the better one stays.
    (chunk_idx, pos, name, score)
    """
    sentences = F.split("content", r"[.!?\n]+", -1)
    if words > 1:
        return _phrases(chunks.select("chunk_idx", sentences.alias("sentences")), k, least, words, alike)
    found = chunks.select(F.col("chunk_idx").cast("long"), F.transform(sentences, T.tokenize).alias("sentences")).mapInArrow(_likely_words(k, least), f"chunk_idx long, found {_COUNTED}")
    scored = F.array_sort(F.transform("found", lambda x: F.struct(_word_score(x).alias("score"), x["w"].alias("w"))))
    best = found.select("chunk_idx", F.posexplode(F.slice(scored, 1, k)).alias("at", "x"))
    return best.select("chunk_idx", (1_000_001 + F.col("at")).alias("pos"), F.upper("x.w").alias("name"), F.col("x.score").alias("score"))


def _word_score(x: Column) -> Column:
    return F.round(F.log(F.log(3.0 + x["first"]) + 1) / (x["tf"] * (1 + x["spread"])), 9)


_COUNTED = "array<struct<w:string,tf:bigint,spread:bigint,first:bigint>>"


def _likely_words(k: int, least: int) -> Callable:
    """Chunks (chunk_idx, sentences) to the counts of the words that may be among their k best; Spark's own scores decide. Nothing is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]):
        for b in (b.slice(lo, ROWS) for b in batches for lo in range(0, b.num_rows, ROWS)):
            # some chunks' words are numbered once, and counted by chunk and number
            column = b.column("sentences")
            inner, many = column.flatten(), pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False)
            coded = inner.flatten().dictionary_encode()
            names, ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            chunk, place = np.repeat(np.arange(b.num_rows), many), np.arange(len(inner)) - np.repeat(np.cumsum(many) - many, many)
            usable = pc.greater_equal(pc.utf8_length(names), least).to_numpy(zero_copy_only=False)[ids]
            ids, sentence = ids[usable], np.repeat(np.arange(len(inner)), sizes)[usable]
            n = max(1, len(names))
            key = chunk[sentence] * n + ids
            order = np.argsort(key, kind="stable")  # a word's sentences stay in order
            key, sentence = key[order], sentence[order]
            new = np.ones(len(key), bool)
            new[1:] = key[1:] != key[:-1]
            said = new.copy()
            said[1:] |= sentence[1:] != sentence[:-1]
            start = np.flatnonzero(new)
            row, word, first = key[start] // n, key[start] % n, place[sentence[start]]
            tf = np.diff(np.append(start, len(key)))
            spread = np.diff(np.append(0, np.cumsum(said))[np.append(start, len(key))])
            score = np.log(np.log(3.0 + first) + 1) / (tf * (1 + spread))
            by = np.lexsort((score, row))
            size = np.bincount(row, minlength=b.num_rows)
            bound = np.full(b.num_rows, np.inf)
            full = size > k
            bound[full] = score[by][(np.cumsum(size) - size)[full] + k - 1] + 1e-8  # more than rounding moves a score
            kept = np.flatnonzero(score <= bound[row])
            counts = [names.take(pa.array(word[kept])), *(pa.array(x[kept].astype(np.int64)) for x in (tf, spread, first))]
            ends = np.append(0, np.cumsum(np.bincount(row[kept], minlength=b.num_rows))).astype(np.int32)
            yield pa.record_batch([b.column("chunk_idx"), pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(counts, names=["w", "tf", "spread", "first"]))], names=["chunk_idx", "found"])

    return run


#: Chunks whose words a task numbers at once.
ROWS = 512


def _phrases(chunks: DataFrame, k: int, least: int, words: int, alike: float) -> DataFrame:
    """One pass over each chunk (chunk_idx, sentences), a batch at a time; nothing is shuffled."""
    tokens = chunks.select(F.col("chunk_idx").cast("long"), F.transform("sentences", T.tokenize).alias("sentences"))

    def run(batches: Iterator[pa.RecordBatch]):
        for b in (b.slice(lo, ROWS) for b in batches for lo in range(0, b.num_rows, ROWS)):
            chunk_ids, column = b.column("chunk_idx").to_pylist(), b.column("sentences")
            # some chunks' words are numbered once; a chunk is a slice of these numbers with its sentences' lengths
            inner = column.flatten()
            coded = inner.flatten().dictionary_encode()
            names, ids = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            usable = pc.greater_equal(pc.utf8_length(names), least).to_numpy(zero_copy_only=False)
            sizes = pc.fill_null(pc.list_value_length(inner), 0).to_numpy(zero_copy_only=False)
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
            at, rows = 0, []
            for chunk, n in zip(chunk_ids, pc.fill_null(pc.list_value_length(column), 0).to_pylist()):
                own = sizes[at : at + n]
                rows += [(chunk, *p) for p in _best_phrases(ids[ends[at] : ends[at + n]], own, names, usable, k, words, alike)]
                at += n
            yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 4, _PHRASE)], names=["chunk_idx", "pos", "name", "score"])

    return tokens.mapInArrow(run, "chunk_idx long, pos int, w string, score double").select("chunk_idx", "pos", F.upper("w").alias("name"), "score")


_PHRASE = (pa.int64(), pa.int32(), pa.string(), pa.float64())
#: Phrases that are looked at first for the best ones.
_LIKELY = 64


def _best_phrases(ids: np.ndarray, sizes: np.ndarray, names: pa.Array, usable: np.ndarray, k: int, words: int, alike: float) -> list[tuple[int, str, float]]:
    """(pos, phrase, score) of a chunk's best phrases, the best first; ids: its words' numbers, sentence after sentence."""
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    own, first, word, tf = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
    said = np.unique(word * (len(sizes) + 1) + sentence)
    spread = np.bincount(said // (len(sizes) + 1), minlength=len(own))
    score = np.round(np.log(np.log(3.0 + sentence[first]) + 1) / (tf * (1 + spread)), 9)
    long = usable[own]
    places, scores = [np.flatnonzero(long)[:, None]], [score[long]]  # words of each phrase, and its score
    for n in range(2, words + 1):
        start = np.arange(max(0, len(ids) - n + 1))
        inside = sentence[start] == sentence[start + n - 1]
        for i in range(n):
            inside &= long[word[start + i]]
        parts = [word[start[inside] + i] for i in range(n)]
        key = parts[0]
        for x in parts[1:]:
            key = key * len(own) + x
        _, at, times = np.unique(key, return_index=True, return_counts=True)
        gram = np.stack([x[at] for x in parts], axis=1)
        product, total = score[gram[:, 0]], score[gram[:, 0]]
        for i in range(1, n):
            product, total = product * score[gram[:, i]], total + score[gram[:, i]]
        places.append(gram)
        scores.append(np.round(product / (times * (1 + total)), 9))
    every = np.concatenate(scores)
    kinds, row = np.repeat(np.arange(len(scores)), [len(x) for x in scores]), np.concatenate([np.arange(len(x)) for x in scores])
    likely = _LIKELY
    while True:
        most = np.partition(every, likely - 1)[likely - 1] if likely < len(every) else np.inf
        found = sorted((float(every[i]), " ".join(names[int(own[w])].as_py() for w in places[kinds[i]][row[i]])) for i in np.flatnonzero(every <= most))
        kept: list[tuple[int, str, float]] = []
        for x, w in found:
            if len(kept) < k and not any(_alike(w, o, alike) for _, o, _ in kept):
                kept.append((1_000_001 + len(kept), w, x))
        if len(kept) == k or likely >= len(every):
            return kept
        likely *= 4


def _alike(a: str, b: str, alike: float) -> bool:
    """Whether 1 - edit distance / longer length is ``alike`` or more."""
    size = max(len(a), len(b))
    within = lambda d: 1 - d / size >= alike
    if not within(abs(len(a) - len(b))) or a != b and not within(1):
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return within(row[-1])
