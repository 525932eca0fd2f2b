"""Writers: every sink writes a new dataset, nothing is changed in place, one output row per path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed_only(files: DataFrame, before: str, after: str) -> DataFrame:
    """Rows whose text changed: what a writer has to write."""
    return files.where(~F.col(before).eqNullSafe(F.col(after)))


def create_if_absent(stubs: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    return stubs.join(existing.select(*keys).distinct(), keys, "left_anti")


def config_text(books: DataFrame, ranges: DataFrame) -> DataFrame:
    """(book, text): the configuration of each book with its chapter ranges in order. ``books`` holds (book, title, author,
    edition, publisher); null fields are empty."""
    r = ranges.groupBy("book").agg(F.sort_array(F.collect_list(F.struct("chapter", "start_page", "end_page"))).alias("rs"))
    row = lambda x: F.format_string('CH%02d_PAGES="%d-%d"', x["chapter"], x["start_page"], x["end_page"])
    b = books.join(r, "book", "left").withColumn("rs", F.coalesce("rs", F.array().cast("array<struct<chapter:int,start_page:int,end_page:int>>")))
    field = lambda k, c: F.concat(F.lit(f'{k}="'), F.coalesce(F.col(c), F.lit("")), F.lit('"'))
    head = F.array(field("BOOK_NAME", "book"), field("TITLE", "title"), field("AUTHOR", "author"), field("EDITION", "edition"), field("PUBLISHER", "publisher"), F.concat(F.lit("NUM_CHAPTERS="), F.size("rs").cast("string")), F.lit(""))
    return b.select("book", F.concat(F.array_join(F.concat(head, F.transform("rs", row)), "\n"), F.lit("\n")).alias("text"))


def page_geometry(width_pt: Column, height_pt: Column) -> Column:
    """Paper size in inches, two decimals, as a preamble states it."""
    return F.format_string("\\geometry{paperwidth=%.2fin,paperheight=%.2fin}", width_pt / 72, height_pt / 72)


def wrapper_text(sections: DataFrame, titles: DataFrame) -> DataFrame:
    """(book, chapter, text): each chapter's wrapper, its sections in page order, then by number. ``sections`` holds (book,
    chapter, stem, first_page)."""
    number = F.regexp_extract("stem", r"_(\d+)$", 1).try_cast("int")
    s = sections.groupBy("book", "chapter").agg(F.sort_array(F.collect_set(F.struct("first_page", number.alias("n"), "stem"))).alias("ss"))
    path = lambda x: F.concat(F.lit("\\input{ch"), F.lpad(F.col("chapter").cast("string"), 2, "0"), F.lit("/"), x["stem"], F.lit("}"))
    head = F.concat(F.lit("\\chapter{"), F.coalesce("title", F.concat(F.lit("Chapter "), F.col("chapter").cast("string"))), F.lit("}\n\\label{ch:"), F.col("chapter").cast("string"), F.lit("}\n\n"))
    return s.join(titles.select("book", "chapter", "title"), ["book", "chapter"], "left").select("book", "chapter", F.concat(head, F.array_join(F.transform("ss", path), "\n"), F.lit("\n")).alias("text"))


def main_text(chapters: DataFrame) -> DataFrame:
    """(book, text): the main file that reads the chapters in order."""
    c = chapters.groupBy("book").agg(F.sort_array(F.collect_set("chapter")).alias("cs"))
    row = lambda n: F.format_string("\\include{ch%02d/ch%02d}", n, n)
    return c.select("book", F.concat(F.lit("\\input{preamble}\n\\begin{document}\n\\input{frontmatter}\n\\mainmatter\n"), F.array_join(F.transform("cs", row), "\n"), F.lit("\n\\backmatter\n\\end{document}\n")).alias("text"))


def progress_table(chapters: DataFrame) -> DataFrame:
    """(book, text): a progress table of (book, chapter, title, start_page, end_page, done)."""
    row = lambda x: F.format_string("| %d | %s | %d-%d | %s |", x["chapter"], F.coalesce(x["title"], F.lit("")), x["start_page"], x["end_page"], F.when(x["done"], "[x]").otherwise("[ ]"))
    c = chapters.groupBy("book").agg(F.sort_array(F.collect_set(F.struct("chapter", "title", "start_page", "end_page", "done"))).alias("cs"))
    return c.select("book", F.concat(F.lit("| Chapter | Title | Pages | Done |\n|---|---|---|---|\n"), F.array_join(F.transform("cs", row), "\n"), F.lit("\n")).alias("text"))


def write_texts(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Texts as files with plain line ends, one directory per partition column."""
    w = df.write.mode("errorifexists").option("lineSep", "\n")
    (w.partitionBy(*partition_by) if partition_by else w).text(path)


def append_results(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)
