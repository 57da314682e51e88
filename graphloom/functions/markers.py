"""Heading markers of legal texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# fixed values: hierarchy levels from high to low
LEVELS = ["phu_luc", "phan", "chuong", "muc", "dieu", "khoan", "diem", "sub_item"]

# fixed values: rule order, level, pattern on the stripped line, label before the captured group (None: the whole line)
RULES = [
    ("phu_luc", r"(?iu)^(?:phụ\s+lục)", None),
    ("phan", r"(?iu)^phần\s+([IVXLCDM]+|\d+)", "Phần "),
    ("chuong", r"(?iu)^chương\s+([IVXLCDM]+|\d+)", "Chương "),
    ("muc", r"(?iu)^mục\s+(\d+|[IVXLCDM]+)", "Mục "),
    ("dieu", r"^(?:ĐIỀU|Điều)\s+(\d+)", "Điều "),
    ("khoan", r"(?iu)^khoản\s+(\d+)", "Khoản "),
    ("sub_item", r"^(\d+\.\d+(?:\.\d+)*)[.\-)]*\s", ""),
    ("khoan", r"^(\d+)[.\-)]\s", "Khoản "),
    ("diem", r"^([a-zđ])[.)]\s", "Điểm "),
]
# fixed values: headings that title a passage; the whole line is the label, and Roman sections count as Mục
TITLES = [
    ("phu_luc", r"(?iu)^phụ\s+lục", None),
    ("phan", r"(?iu)^phần\s+([IVXLCDM]+|\d+)", None),
    ("chuong", r"(?iu)^chương\s+([IVXLCDM]+|\d+)", None),
    ("muc", r"(?iu)^mục\s+(\d+|[IVXLCDM]+)", None),
    ("muc", r"^(?:IX|IV|V?I{1,3})[\-.]\s+[A-ZÀ-Ỹ]", None),
    ("dieu", r"(?iu)^điều\s+\d+", None),
]
# fixed value: any heading at a line's begin (annexes are not among these)
ANY = (
    r"(?:^|\n)\s*(?:(?:PHẦN|Phần)\s+[IVXLCDM\d]|(?:CHƯƠNG|Chương)\s+[IVXLCDM\d]|(?:MỤC|Mục)\s+[IVXLCDM\d]|(?:ĐIỀU|Điều)\s+\d+"
    r"|(?:Khoản|KHOẢN)\s+\d+|\d+\.\d+(?:\.\d+)*[.\-)]*\s|\d+[.\-)]\s|[a-zđ][.)]\s)"
)


def has_markers(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(ANY)


def classify(line: Column, rules: list = RULES) -> Column:
    """struct(level, label) of a line, both empty where it is no heading; the first rule that fits counts."""
    return classify_stripped(strip(line), rules)


def classify_stripped(s: Column, rules: list = RULES) -> Column:
    found = None
    for level, pattern, label in rules:
        text = s if label is None else F.concat(F.lit(label), F.regexp_extract(s, pattern, 1))
        value = F.struct(F.lit(level).alias("level"), text.alias("label"))
        found = F.when(s.rlike(pattern), value) if found is None else found.when(s.rlike(pattern), value)
    return found.otherwise(F.struct(F.lit("").alias("level"), F.lit("").alias("label")))
