"""Problem 2: oversized items cut at natural boundaries, with overlap.

Two forms of one recursive separator hierarchy with greedy packing:

* ``page_pieces``: page ranges of chapters. The natural boundary is a page after which a section begins; where none is
  within reach the hierarchy falls to its next level, the bare page. Neighbours share exactly one page.
* ``text_pieces``: texts. Levels are section, paragraph, sentence, word and character; a unit too long for the limit
  is opened at the next level, the units are packed greedily and each piece repeats trailing units of the one before
  up to the overlap.

Both work row by row on values that stand in one row (the pages of a chapter, one text), in linear time.

Defined cases
-------------
* a chapter's row with the latest ``loaded_at`` holds (null is earliest, ties by the largest end, start and title);
  null page, reversed range or a length within the limit: no piece.
* sections of null or impossible page never match; repeated ones count once; null book or chapter: no case.
* null, empty or blank text: no piece. A text within the limit is one piece. A single character is never split.
* empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.cluster import latest

PAGES = 6
LIMIT, OVERLAP = 800, 80

_PIECE = "array<struct<piece_start:int,piece_end:int>>"


def cut_range(start: int, end: int, breaks: set[int], limit: int = PAGES) -> list[tuple[int, int]]:
    """Consecutive ranges of at most ``limit`` pages; ``breaks`` are the last pages before a section begins."""
    out, s = [], start
    while end - s + 1 > limit:
        reach = s + limit - 1
        e = next((p for p in range(reach, s, -1) if p in breaks), reach)
        out.append((s, e))
        s = e
    out.append((s, end))
    return out


def page_pieces(chapters: DataFrame, sections: DataFrame, limit: int = PAGES) -> DataFrame:
    """(book, chapter, piece_start, piece_end) of the chapters longer than ``limit`` pages. The distinct section pages of
    a chapter are combined on the map side, so repeated rows of one key never gather in a task."""
    rows = chapters.where("book is not null and chapter is not null").select("book", "chapter", "end_page", "start_page", "title", "loaded_at")
    rows = latest(rows, ["book", "chapter"], "loaded_at").where(F.col("end_page") - F.col("start_page") >= limit)
    marks = sections.where("book is not null and chapter is not null and page_no is not null").select("book", "chapter", "page_no").distinct()
    marks = marks.groupBy("book", "chapter").agg(F.collect_list(F.col("page_no") - 1).alias("breaks"))
    rows = rows.join(marks, ["book", "chapter"], "left")

    @F.pandas_udf(_PIECE)
    def pieces(start: pd.Series, end: pd.Series, breaks: pd.Series) -> pd.Series:
        return pd.Series([
            [{"piece_start": a, "piece_end": b} for a, b in cut_range(int(s), int(e), set() if k is None else {int(x) for x in k}, limit)]
            for s, e, k in zip(start, end, breaks)
        ])

    rows = rows.select("book", "chapter", F.explode(pieces("start_page", "end_page", "breaks")).alias("p"))
    return rows.select("book", "chapter", "p.piece_start", "p.piece_end")


#: The hierarchy: each separator stays with the unit that it ends or begins. Fixed values.
LEVELS = (
    ("section", re.compile(r"(?=^\\(?:chapter|section|subsection)\b|^#{1,6} )", re.M)),
    ("paragraph", re.compile(r"(?<=\n\n)(?!\n)")),
    ("sentence", re.compile(r"(?<=[.!?…])(?=\s)|(?<=[.!?…][\"')\]])(?=\s)")),
    ("word", re.compile(r"(?<=\s)(?=\S)")),
)


def _units(text: str, at: int, level: int, limit: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, level) of units no longer than ``limit`` that tile ``text`` from ``at``."""
    if len(text) <= limit:
        yield at, at + len(text), level
        return
    if level == len(LEVELS):
        for i in range(0, len(text), limit):
            yield at + i, at + min(i + limit, len(text)), level
        return
    edges = [0, *sorted({m.start() for m in LEVELS[level][1].finditer(text)} - {0, len(text)}), len(text)]
    for a, b in zip(edges, edges[1:]):
        yield from _units(text[a:b], at + a, level + 1, limit)


def cut_text(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int]]:
    """(start, end, overlap with the piece before) of the pieces of one text. Pieces are substrings of at most ``limit``
    characters; from a piece to the next at most ``overlap`` characters are repeated, in whole units where units of that
    size exist, else in single characters."""
    if len(text) <= limit:
        return [(0, len(text), 0)]
    units = list(_units(text, 0, 0, limit - overlap))
    out: list[tuple[int, int, int]] = []
    start = shared = 0
    edges = [0]
    for a, b, _ in units:
        if b - start > limit:
            out.append((start, a, shared))
            back = [e for e in edges if a - overlap <= e < a and e > start]
            fresh = min(back) if back else max(start + 1, a - overlap)
            # the word begun inside the overlap is repeated whole where there is one
            if not back and (m := re.search(r"\s(?=\S)", text[fresh:a])):
                fresh += m.end()
            start, shared = fresh, a - fresh
            edges = [e for e in edges if e >= start]
        edges.append(b)
    out.append((start, len(text), shared))
    return out


def text_pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, piece_no, start_char, end_char, overlap_chars, piece): zero-based half-open offsets in code points."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be shorter than the limit")

    @F.pandas_udf("array<struct<piece_no:int,start_char:int,end_char:int,overlap_chars:int,piece:string>>")
    def pieces(texts: pd.Series) -> pd.Series:
        return pd.Series([
            [{"piece_no": i, "start_char": a, "end_char": b, "overlap_chars": o, "piece": t[a:b]} for i, (a, b, o) in enumerate(cut_text(t, limit, overlap), 1)]
            if t and not t.isspace() else []
            for t in texts
        ])

    rows = docs.where(F.col(text).isNotNull()).select(F.col(key), F.explode(pieces(F.col(text))).alias("p"))
    return rows.select(key, "p.*")
