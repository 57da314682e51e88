"""Text functions as Column expressions; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: characters that the slug rule folds, letter by letter
FOLDED = {
    "a": "àáảãạăằắẳẵặâầấẩẫậäåā", "e": "èéẻẽẹêềếểễệëē", "i": "ìíỉĩịïîī", "o": "òóỏõọôồốổỗộơờớởỡợöøō",
    "u": "ùúủũụưừứửữựüûū", "y": "ỳýỷỹỵÿ", "d": "đ", "n": "ñ", "c": "ç",
}
# fixed values: the ASCII punctuation characters
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# fixed values: Unicode's white space but for the blank
WHITE = "\t\n\x0b\x0c\r\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space (any Unicode) at both ends."""
    return F.btrim(c, F.lit(" " + WHITE))


def normalize_text(c: Column) -> Column:
    """Null is empty; CR is a newline; runs of blanks are one; three or more newlines are two; stripped."""
    s = F.translate(F.coalesce(c, F.lit("")), "\r", "\n")
    s = F.regexp_replace(s, r"[ \t]+", " ")
    return strip(F.regexp_replace(s, r"\n{3,}", "\n\n"))


def clean_text(c: Column) -> Column:
    """The loader's cleaning, in its order: newlines, blank lines, line ends, lines of asterisks, runs of blanks."""
    s = F.regexp_replace(c, r"\r\n?", "\n")
    s = F.regexp_replace(s, r"(?U)\n\s*\n", "\n\n")
    s = F.regexp_replace(s, r"(?mU)^[\s&&[^\n]]+|[\s&&[^\n]]+$", "")
    s = F.regexp_replace(s, r"\n\*+\n", "\n")
    s = F.regexp_replace(s, r"(?m)^\*+$", "")
    s = F.regexp_replace(s, r"[ \t]+", " ")
    return strip(F.regexp_replace(s, r"\n{3,}", "\n\n"))


def doc_number(stem: Column) -> Column:
    """A file stem without one trailing _<digits>, underscores as slashes."""
    return F.translate(F.regexp_replace(stem, r"_(\d+)$", ""), "_", "/")


def issuing_body(content: Column) -> Column:
    """The first of the first ten lines that is not blank, not the asterisk line and holds neither motto; else empty."""
    lines = F.transform(F.slice(F.split(content, "\n", -1), 1, 10), strip)
    fits = lambda x: (x != "") & (x != "********") & ~F.contains(x, F.lit("CỘNG")) & ~F.contains(x, F.lit("Độc lập"))
    return F.coalesce(F.try_element_at(F.filter(lines, fits), F.lit(1)), F.lit(""))


def slugify(c: Column) -> Column:
    """Lower-case ASCII letters and digits joined by single underscores; accents folded."""
    s = F.lower(c)
    for base, accented in FOLDED.items():
        s = F.translate(s, accented, base * len(accented))
    s = F.regexp_replace(s, r"\p{Mn}+", "")
    return F.regexp_replace(F.regexp_replace(s, "[^a-z0-9]+", "_"), "^_+|_+$", "")


def range_id(number: Column, start: Column, end: Column) -> Column:
    """chunk_<doc>_<start>[_to_<end>], each part slugged; defaults unknown and root."""
    doc, first, last = (F.coalesce(F.nullif(slugify(x), F.lit("")), F.lit(d)) for x, d in ((number, "unknown"), (start, "root"), (end, "")))
    spans = (F.coalesce(end, F.lit("")) != "") & (end != start)
    return F.concat(F.lit("chunk_"), doc, F.lit("_"), first, F.when(spans, F.concat(F.lit("_to_"), last)).otherwise(F.lit("")))


def tokenize(c: Column) -> Column:
    """Lower-case words; ASCII punctuation and Unicode white space separate."""
    between = PUNCTUATION + WHITE
    return F.filter(F.split(F.translate(F.lower(F.coalesce(c, F.lit(""))), between, " " * len(between)), " "), lambda x: x != "")


def n_tokens(c: Column) -> Column:
    """The default token count: words between white space."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(r"(?U)\S+")).cast("int")


def lines_shown(c: Column) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(F.split(c, "\n", -1), strip), lambda x: x != "")


def is_corrupted_block(c: Column, short: int = 12, share: float = 0.60) -> Column:
    """A broken table: six or more lines shown, of which at least 60 % have at most 12 characters."""
    return _mostly_short(lines_shown(c), short, share)


def _mostly_short(lines: Column, short: int = 12, share: float = 0.60) -> Column:
    return (F.size(lines) >= 6) & (F.size(F.filter(lines, lambda x: F.length(x) <= short)) >= share * F.size(lines))


def collapse_block(c: Column) -> Column:
    return F.array_join(lines_shown(c), " ")


def collapse_blocks(blocks: Column) -> Column:
    """An array of blocks, broken tables among them as one line each; the lines of a block are taken once."""
    shown = F.transform(blocks, lambda b: F.struct(b.alias("b"), F.when(F.contains(b, F.lit("\n")), lines_shown(b)).alias("lines")))
    return F.transform(shown, lambda x: F.when(_mostly_short(x["lines"]), F.array_join(x["lines"], " ")).otherwise(x["b"]))


def entity_name(c: Column) -> Column:
    return F.upper(strip(F.coalesce(c, F.lit(""))))


def weight(c: Column) -> Column:
    """A number in [0.1, 1]; what is no number is 0.5."""
    return F.greatest(F.lit(0.1), F.least(F.lit(1.0), F.coalesce(c.try_cast("double"), F.lit(0.5))))


def truncate(c: Column, n: int, mark: str = "") -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(mark))).otherwise(c)


def query_text(c: Column) -> Column:
    """Questions are embedded behind a prefix, documents are not."""
    return F.concat(F.lit("query: "), c)


def question(query: Column, case: Column) -> Column:
    """A case study's question behind its case."""
    composed = F.concat(F.lit("[Tình huống thực tế]: "), case, F.lit("\n[Câu hỏi]: "), query)
    return F.when(F.coalesce(case, F.lit("")) != "", composed).otherwise(query)


def json_objects(c: Column) -> Column:
    """The objects of the first-to-last bracket span, as JSON strings; empty if that is no array.

    Elements are parsed one by one, so one that is no object is left out and not the whole.
    """
    span = F.regexp_extract(F.coalesce(c, F.lit("")), r"(\[[\s\S]*\])", 1)
    whole = F.try_parse_json(F.concat(F.lit('{"v":'), span, F.lit("}")))  # wrapped, so that text behind the array is an error
    elements = F.from_json(F.when(whole.isNotNull(), span), "array<string>", {"allowSingleQuotes": "false"})
    return F.coalesce(F.filter(elements, lambda x: F.ltrim(x).startswith("{")), F.array().cast("array<string>"))
