"""Portable text expressions: Spark columns whose results do not depend on a regex dialect's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word character as Unicode has it, in every regex dialect used here. Fixed value.
WORD = r"[\p{L}\p{N}_]"
#: Lines that hold paths, references or captions are not mathematics. Fixed values.
NOT_MATH = (
    r"\\includegraphics|\\input\b|\\include\b|\\label\b|\\ref\b|\\caption\b|\\bibliography|\\url\b|\\href\b|\.png|\.pdf|\.tex"
)


def utf8_text(raw: Column) -> Column:
    """Bytes as text, malformed bytes as U+FFFD, all line ends as ``\\n``."""
    return F.regexp_replace(F.make_valid_utf8(raw.cast("string")), r"\r\n?", "\n")


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def stripped(text: Column) -> Column:
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def without_comments(text: Column) -> Column:
    """Everything from an unescaped ``%`` to the end of its line removed; line ends are ``\\n`` alone."""
    return F.regexp_replace(text, r"(?d)(?<!\\)%.*", "")


def is_math_line(line: Column) -> Column:
    return ~(line.rlike(NOT_MATH) | line.rlike(r"^\s*%"))


def count_of(text: Column, pattern: str) -> Column:
    """Matches of a pattern in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0)).cast("bigint")


def slug(title: Column) -> Column:
    """Lower case, letters and digits and underscores only, nothing from the first ``_with_`` on, at most 50 characters."""
    s = F.regexp_replace(F.lower(title), r"[^a-z0-9\s]", "")
    s = F.regexp_replace(stripped(s), r"\s+", "_")
    return F.substring(F.element_at(F.split(s, "_with_"), 1), 1, 50)


def plain_name(name: Column) -> Column:
    """Whether a name can be one directory's name: not empty, no separators, no ``..``."""
    return F.coalesce((name != "") & ~name.contains("/") & ~name.contains("\\") & ~name.contains(".."), F.lit(False))


def int_of(text: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit("")).try_cast("int")
