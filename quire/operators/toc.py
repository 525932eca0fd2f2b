"""Tables of contents, page ranges, chunks, slugs and split output. Null texts hold no entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import lines, slug, stripped

#: Entry patterns in order of preference: the first with any match counts for the whole text. Fixed patterns.
ENTRIES = (
    r"(?m)(?:Chapter\s+)?(\d{1,2})\s+([A-Z][^\d\n]{5,}?)\s*\.{0,}\s*(\d{1,4})\s*$",
    r"(?m)^(\d{1,2})\.\s+([A-Z][^\d\n]{5,}?)\s+(\d{1,4})\s*$",
    r"(?m)^(\d{1,2})\s{2,}([A-Z][^\d\n]{5,}?)\s{2,}(\d{1,4})\s*$",
)
MAX_CHAPTER, FRONT_PAGES, CHUNK = 30, 20, 6


def entries(text: Column) -> Column:
    """Array of (chapter, title, page) of a text, by the first pattern that matches at all."""
    options = []
    for p in ENTRIES:
        groups = [F.regexp_extract_all(text, F.lit(p), F.lit(i)) for i in (1, 2, 3)]
        rows = F.transform(
            F.arrays_zip(*[g.alias(n) for g, n in zip(groups, "ctp")]),
            lambda x: F.struct(x["c"].cast("int").alias("chapter"), F.regexp_replace(stripped(x["t"]), r"\.+$", "").alias("title"), x["p"].cast("int").alias("page")),
        )
        options.append(F.when(F.size(rows) > 0, rows))
    return F.coalesce(*options)


def chapter_ranges(fronts: DataFrame, key: str = "book", text: str = "text", pages: str = "n_pages") -> DataFrame:
    """(key, chapter, title, start_page, end_page): plausible entries, one per chapter (the smallest title, then page); a
    chapter ends before the next begins, the last one on the last page."""
    e = fronts.select(key, pages, F.explode(entries(F.col(text))).alias("e")).select(key, pages, "e.*")
    e = e.where(F.col("chapter").between(1, MAX_CHAPTER) & (F.col("page") < F.col(pages)))
    one = e.groupBy(key, "chapter").agg(F.min(F.struct("title", "page", pages)).alias("m")).select(key, "chapter", "m.*")
    after = F.lead("page").over(Window.partitionBy(key).orderBy("chapter"))
    return one.select(key, "chapter", "title", F.col("page").alias("start_page"), F.coalesce(after - 1, F.col(pages) - 1).cast("int").alias("end_page"))


def page_chunks(ranges: DataFrame, keys: list[str], start: str, end: str, size: int = CHUNK) -> DataFrame:
    """Tumbling windows of ``size`` pages over each range; reversed and null ranges have none."""
    rows = ranges.where(F.col(start) <= F.col(end))
    s = F.explode(F.sequence(F.col(start), F.col(end), F.lit(size))).alias("chunk_start")
    return rows.select(*keys, F.col(end).alias("__e"), s).select(*keys, "chunk_start", F.least(F.col("chunk_start") + size - 1, F.col("__e")).alias("chunk_end"))


def overlaps(ranges: DataFrame, key: str, ident: str, start: str, end: str, block: int = 16) -> DataFrame:
    """(key, a, b), a < b, of ranges of one key that share a page. An interval join as an equi-join: ranges meet in the
    blocks of pages they touch, so neither a hot key nor a long range compares with all others."""
    r = ranges.where(F.col(start) <= F.col(end)).select(key, ident, start, end)
    r = r.withColumn("__b", F.explode(F.sequence(F.floor(F.col(start) / block), F.floor(F.col(end) / block))))
    a = r.select(key, "__b", *[F.col(c).alias(f"a_{c}") for c in (ident, start, end)])
    b = r.select(key, "__b", *[F.col(c).alias(f"b_{c}") for c in (ident, start, end)])
    hit = (F.col(f"a_{ident}") < F.col(f"b_{ident}")) & (F.col(f"a_{start}") <= F.col(f"b_{end}")) & (F.col(f"b_{start}") <= F.col(f"a_{end}"))
    return a.join(b, [key, "__b"]).where(hit).select(key, F.col(f"a_{ident}").alias("a"), F.col(f"b_{ident}").alias("b")).distinct()


def first_line(text: Column) -> Column:
    """First line with anything on it, stripped."""
    return F.try_element_at(F.filter(F.transform(lines(text), stripped), lambda x: x != ""), F.lit(1))


def page_text(pages: DataFrame, key: str, page: str, text: str, header: bool = True, first: int | None = None) -> DataFrame:
    """(key, text): pages in order as one text, optionally the first ``first`` pages, with a header before each."""
    rows = pages.where(F.col(page) <= first) if first is not None else pages
    piece = F.concat(F.lit("--- Page "), F.col(page).cast("string"), F.lit(" ---\n"), F.coalesce(text, F.lit(""))) if header else F.coalesce(text, F.lit(""))
    got = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(page).alias("p"), piece.alias("t")))).alias("ps"))
    return got.select(key, F.array_join(F.transform("ps", lambda x: x["t"]), "\n\n").alias("text"))


def span_text(pages: DataFrame, spans: DataFrame, key: str, page: str, text: str) -> DataFrame:
    """(key, start_page, end_page, text): the pages of each span, both ends included, beyond the last page nothing. Spans
    meet pages by an equi-join on their page numbers."""
    s = spans.where("start_page <= end_page").select(key, "start_page", "end_page", F.explode(F.sequence("start_page", "end_page")).alias(page))
    piece = F.concat(F.lit("--- Page "), F.col(page).cast("string"), F.lit(" ---\n"), F.coalesce(text, F.lit("")))
    got = s.join(pages.select(key, page, text), [key, page]).groupBy(key, "start_page", "end_page").agg(F.sort_array(F.collect_list(F.struct(F.col(page).alias("p"), piece.alias("t")))).alias("ps"))
    return got.select(key, "start_page", "end_page", F.array_join(F.transform("ps", lambda x: x["t"]), "\n\n").alias("text"))


def printed_dump(pages: DataFrame, key: str, page: str, text: str, offset: int) -> DataFrame:
    """(key, page, piece): each page under its PDF page and printed page (PDF page less ``offset``), to be written in page
    order. One row per page: a document of any size is never one value."""
    head = F.format_string("=== PDF page %d, printed page %d ===\n", F.col(page), F.col(page) - offset)
    return pages.where(F.col(page).isNotNull()).select(key, page, F.concat(head, F.coalesce(text, F.lit("")), F.lit("\n")).alias("piece"))


FILE_MARK = r"%%%\s*FILE:\s*(sec\d+_\d+\.tex)\s*%%%"


def split_files(texts: DataFrame, keys: list[str], text: str, chapter: str) -> DataFrame:
    """(keys, filename, content): a text with file markers as its files, one without as a single first section."""
    names = F.regexp_extract_all(F.col(text), F.lit(FILE_MARK), F.lit(1))
    bodies = F.transform(F.slice(F.split(text, FILE_MARK, -1), 2, 1_000_000), lambda b: F.concat(stripped(b), F.lit("\n")))
    single = F.array(F.struct(F.concat(F.lit("sec"), F.lpad(F.col(chapter).cast("string"), 2, "0"), F.lit("_1.tex")).alias("n"), F.concat(F.col(text), F.lit("\n")).alias("b")))
    many = F.transform(F.arrays_zip(names.alias("n"), bodies.alias("b")), lambda x: F.struct(x["n"].alias("n"), x["b"].alias("b")))
    return texts.where(F.col(text).isNotNull()).select(*keys, F.posexplode(F.when(F.size(names) > 0, many).otherwise(single)).alias("ord", "f")).select(*keys, "ord", F.col("f.n").alias("filename"), F.col("f.b").alias("content"))


def unconverted(ranges: DataFrame, files: DataFrame) -> DataFrame:
    """Chapters that have no section file yet."""
    done = files.where(F.col("stem").startswith("sec") & F.col("chapter").isNotNull()).select("book", "chapter").distinct()
    return ranges.join(done, ["book", "chapter"], "left_anti")


__all__ = ["entries", "chapter_ranges", "page_chunks", "overlaps", "first_line", "page_text", "split_files", "unconverted", "slug"]
