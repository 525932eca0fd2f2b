"""Queries of the core operators over the driver's tables. Each runs over its whole tables.

The tables hold books, chapters, pages, source files and results as they are. Where an operator's input is not among them
(logs, figure captions, blocks), a carrier renders rows of a table into that input, in the same way in the SQL beside it;
the carriers are in this module, marked as such.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.cluster import latest, read
from quire.functions.text import plain_name, slug
from quire.operators import checks, figures, identity, inventory, logs, progress, results, rewrite, schema_drift, toc
from quire.sources import readers, writers

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    Q[f.__name__] = f
    return f


# --- schemas that drift (problem 1) ----------------------------------------------------------------------------------
@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.changes(read(spark, d, "book_conf"))


@query
def p1_table(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.consistent_table(read(spark, d, "book_conf"))


@query
def p1_values(spark: SparkSession, d: str) -> DataFrame:
    """Every key of every revision in one consistent table."""
    return schema_drift.values(read(spark, d, "book_conf"))


@query
def p1_changes(spark: SparkSession, d: str) -> DataFrame:
    """The changes of all fields, not of the three alone."""
    return schema_drift.all_changes(read(spark, d, "book_conf"))


@query
def p1_schema(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.fused_schema(read(spark, d, "book_conf"))


# --- source files -------------------------------------------------------------------------------------------------------
def _files(spark: SparkSession, d: str, suffix: str | None = None) -> DataFrame:
    f = read(spark, d, "source_file")
    return f.where(F.col("suffix") == suffix) if suffix else f


def _once(df: DataFrame, *cols: str) -> DataFrame:
    """Latest row of each file; only the columns given are shuffled."""
    return latest(df.select("file_id", "loaded_at", *cols), ["file_id"], "loaded_at").drop("loaded_at")


@query
def element_inventory(spark: SparkSession, d: str) -> DataFrame:
    names = list(inventory.ELEMENTS)
    counts = inventory.element_counts(_files(spark, d, "tex").where("chapter is not null").select("file_id", "loaded_at", "book", "chapter", "content"))
    return inventory.rolled_up(_once(counts, "book", "chapter", *names), ["book", "chapter"], names)


@query
def figure_total(spark: SparkSession, d: str) -> DataFrame:
    counts = inventory.element_counts(_files(spark, d, "tex").select("file_id", "loaded_at", "content"), elements={"figures": inventory.ELEMENTS["figures"], "strict_items": inventory.STRICT["exercises"]})
    return _once(counts, "figures", "strict_items").agg(F.sum("figures").alias("figures"), F.sum("strict_items").alias("strict_items"))


@query
def symbol_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = _files(spark, d, "tex").withColumn("terms", inventory.terms_of(F.col("content"), inventory.SYMBOLS))
    return inventory.top_of(_once(rows, "terms"), "terms", [], 40)


@query
def subscript_topk(spark: SparkSession, d: str) -> DataFrame:
    rows = _files(spark, d, "tex").where("chapter is not null").withColumn("terms", inventory.terms_of(F.col("content"), inventory.SUBSCRIPTS))
    return inventory.top_of(_once(rows, "chapter", "terms"), "terms", ["chapter"], 40)


@query
def book_inventory(spark: SparkSession, d: str) -> DataFrame:
    f = _once(_files(spark, d), "book", "chapter", "suffix")
    return f.groupBy("book").agg(F.countDistinct("chapter").alias("chapters"), F.count_if(F.col("suffix") == "tex").alias("tex_files"), F.count_if(F.col("suffix") != "tex").alias("other_files"))


def _broken(c: Column) -> Column:
    """Carrier: sound LaTeX with the damage that the rules repair, put in by fixed replacements."""
    for a, b in (
        (r"\\(begin|end)\{remark\}", r"\\$1{boxed}"), (r"\\(begin|end)\{example\}", r"\\$1{defbox}"), (r"Let \$([^$]+)\$", r"Let \\boxed{\$$1\$}"),
        (r"(?s)\\\[\n(.*?)\n\\\]", "\\\\boxed{\\\\[\n$1\n\\\\]}"), (r"\\partial_\{([a-z])\}", r"\\frac{partial}{partial $1}"), (r"\\end\{proof\}", "\\\\hfill\\$\\\\blacksquare\\$\n\\\\qed\n\\\\end{proof}"),
        (r"\\mathbb\{R\}", r"\\bold{R}"), (r"([a-z])\^\{([0-9])([0-9])\}", r"$1^$2^$3"), (r"([a-z])_\{([0-9])([0-9])\}", r"$1_$2_$3"), (r"\\sqrt", "\f\\\\sqrt"),
    ):
        c = F.regexp_replace(c, a, b)
    return c


@query
def rewrite_chain(spark: SparkSession, d: str) -> DataFrame:
    rows = _files(spark, d, "tex").where("content is not null").select("file_id", "loaded_at", _broken(F.col("content")).alias("content"))
    out = rewrite.rewritten(rows).withColumn("content_md5", F.md5("content"))
    return _once(out, "content_md5", *[c for c in out.columns if c.startswith("n_")], "changed", "total_fixes")


@query
def rewrite_as_is(spark: SparkSession, d: str) -> DataFrame:
    out = rewrite.rewritten(_files(spark, d, "tex").select("file_id", "loaded_at", "book", "content"))
    return _once(out, "book", "changed", "total_fixes").groupBy("book").agg(F.count("*").alias("files"), F.count_if("changed").alias("changed"), F.sum("total_fixes").alias("fixes"))


@query
def wrapper_integrity(spark: SparkSession, d: str) -> DataFrame:
    f = _files(spark, d, "tex").withColumn("content", F.when(F.col("stem").startswith("ch"), F.col("content")))
    return checks.wrapper_violations(_once(f, "book", "chapter", "stem", "rel_path", "content"))


@query
def env_balance(spark: SparkSession, d: str) -> DataFrame:
    f = _files(spark, d, "tex").where("stem like 'sec%'")
    return checks.balance_violations(_once(f, "book", "chapter", "stem", "content"))


@query
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    f = _files(spark, d, "tex").where("stem like 'sec%' and book is not null and chapter is not null").withColumn("first_page", checks.pages_header(F.col("content")))
    f = _once(f, "book", "chapter", "stem", "first_page")
    return f.withColumn("position", F.row_number().over(Window.partitionBy("book", "chapter").orderBy("first_page", "stem", "file_id"))).select("book", "chapter", "file_id", "stem", "first_page", "position")


@query
def layout_required(spark: SparkSession, d: str) -> DataFrame:
    return checks.missing_required(_files(spark, d))


@query
def leftover_notes(spark: SparkSession, d: str) -> DataFrame:
    rows = checks.leftovers(_files(spark, d).where(F.col("suffix").isin(*checks.TEXT_SUFFIXES)), ["file_id"], "content")
    return rows.distinct()


@query
def placeholder_images(spark: SparkSession, d: str) -> DataFrame:
    rows = checks.leftovers(_files(spark, d, "tex"), ["file_id"], "content", r"placeholder\.png|\\includegraphics(?:\[[^\]]*\])?\{\s*\}|\\(?:input|include)\{\s*\}")
    return rows.distinct()


@query
def forbidden_scan(spark: SparkSession, d: str) -> DataFrame:
    docs = read(spark, d, "documents").select("doc_id", "source", F.concat(F.col("text"), _notice()).alias("text"))
    return checks.forbidden_markers(docs, ["doc_id"], "text")


@query
def placeholder_planted(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: the images of the sources replaced by placeholders."""
    f = _files(spark, d, "tex").withColumn("content", F.regexp_replace("content", r"fig_[0-9_]+\.png", "placeholder.png"))
    return checks.leftovers(f, ["file_id"], "content", r"placeholder\.png").distinct()


@query
def layout_of_all_books(spark: SparkSession, d: str) -> DataFrame:
    """Required files that books lack, books without any file among them."""
    return checks.missing_required(_files(spark, d), books=read(spark, d, "chapter_range"))


@query
def legacy_paths(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: the files of every third book, by the length of its name, as if they lay at the root of the tree."""
    own = F.length("book") % 3 == 0
    path = F.when(own, F.when(F.col("rel_path").startswith("scripts/"), "docs/progress.md").otherwise(F.col("rel_path"))).otherwise(F.concat(F.lit("books/"), F.col("book"), F.lit("/"), F.col("rel_path")))
    return checks.legacy_paths(_files(spark, d).where("book is not null").select(path.alias("path")))


@query
def violations_all(spark: SparkSession, d: str) -> DataFrame:
    """All six checks as one table of violations, counted."""
    return _violations(spark, d).groupBy("check", "code").agg(F.count("*").alias("n"), F.countDistinct("scope").alias("scopes"))


@query
def violations_of_a_book(spark: SparkSession, d: str) -> DataFrame:
    """The violations of the book that has most files."""
    book = _files(spark, d).where("book is not null").groupBy("book").agg(F.countDistinct("file_id").alias("n")).orderBy(F.desc("n"), "book").first()
    return checks.of_book(_violations(spark, d), book["book"] if book else "").groupBy("check", "object", "code").agg(F.count("*").alias("n"))


def _violations(spark: SparkSession, d: str) -> DataFrame:
    of_file = _once(_files(spark, d), "book")
    note, image = leftover_notes(spark, d).join(of_file, "file_id"), placeholder_planted(spark, d).join(of_file, "file_id")
    none = F.lit(None).cast("string")
    return checks.all_violations(
        ("layout", layout_required(spark, d), [F.col("book"), F.col("rel_path"), F.lit("missing")]),
        ("wrapper", wrapper_integrity(spark, d), [F.col("book"), F.col("stem"), F.col("code")]),
        ("balance", env_balance(spark, d), [F.col("book"), F.col("name"), F.col("code")]),
        ("marker", forbidden_scan(spark, d), [none, F.col("doc_id"), F.col("marker")]),
        ("leftover", note, [F.col("book"), F.col("file_id"), F.lit("note")]),
        ("image", image, [F.col("book"), F.col("file_id"), F.lit("placeholder")]),
    )


def _notice() -> Column:
    """Carrier: a notice after some documents, chosen by length, for the markers that the texts lack."""
    n = F.length("text") % 11
    return F.when(n == 0, F.lit("\nISBN 0-00")).when(n == 1, F.lit("\nAll Rights reserved.")).when(n == 2, F.lit("\nLibrary of Congress")).when(n == 3, F.lit("\n\\textcopyright{} 2020")).when(n == 4, F.lit("\n\\Copyright")).otherwise(F.lit("\nCopyright 2020"))


@query
def violations(spark: SparkSession, d: str) -> DataFrame:
    """Several checks as one table of violations with counts."""
    parts = checks.all_violations(
        ("layout", layout_required(spark, d), [F.col("book"), F.col("rel_path"), F.lit("missing")]),
        ("wrapper", wrapper_integrity(spark, d), [F.col("book"), F.col("stem"), F.col("code")]),
    )
    return parts.groupBy("check", "code").agg(F.count("*").alias("n"), F.countDistinct("scope").alias("books"))


@query
def scrub_rescan(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: the noticed documents as targets, scrubbed by a rule chosen by length; some rules cannot remove it all."""
    docs = read(spark, d, "documents").where("text is not null").select(F.col("doc_id").cast("string").alias("rel_path"), F.concat(F.lit("- **Publisher**: none\n% Copyright page\n"), F.col("text"), _notice(), F.lit("\n\\cleardoublepage\n")).alias("content"), F.length("text").alias("n"))
    targets = docs.select("rel_path", F.when(F.col("n") % 3 == 0, "line").when(F.col("n") % 3 == 1, "page").otherwise("notice").alias("scrub"))
    patterns = {
        "line": [rewrite.marked_line(r"- \*\*Publisher\*\*:")],
        "page": [rewrite.bounded_block(r"% Copyright page\n", r"\\cleardoublepage\n", r"\\mainmatter")],
        "notice": [(r"(?i)\n(?:ISBN 0-00|All rights reserved\.|Library of Congress|\\textcopyright\{\} 2020|\\copyright)\n", "\n"), rewrite.block_to_end(r"\nCopyright 2020", r"\\cleardoublepage")],
    }
    out = rewrite.scrubbed(docs, targets, patterns, tuple(p for _, p in checks.FORBIDDEN))
    return out.select("rel_path", "scrub", "status", "removed_chars")


@query
def figure_paths(spark: SparkSession, d: str) -> DataFrame:
    f = _once(_files(spark, d, "tex").where("book is not null and content is not null"), "book", "content")
    label = F.regexp_extract_all("content", F.lit(r"\\label\{fig:(\d+)_(\d+)(?:_\d+)?\}"), F.lit(0))
    figs = f.select("book", F.explode(label).alias("l")).select("book", F.regexp_replace(F.regexp_extract("l", r"fig:([\d_]+)", 1), "_", ".").alias("fig_id")).distinct()
    # every second figure has an image
    figs = figs.where(F.length("fig_id") % 2 == 1).withColumn("path", figures.image_path(F.element_at(F.split("fig_id", r"\."), 1), F.col("fig_id")))
    out = figures.rewritten_paths(f, figs, ["book"])
    return out.select("file_id", "changed", F.md5("content").alias("content_md5"))


@query
def figure_reconcile(spark: SparkSession, d: str) -> DataFrame:
    f = _files(spark, d, "tex").where("book is not null and content is not null")
    f = f.withColumn("labels", F.regexp_extract_all("content", F.lit(r"\\label\{fig:([\d_]+)\}"), F.lit(1))).withColumn("images", F.regexp_extract_all("content", F.lit(r"fig_([\d_]+)\.png"), F.lit(1)))
    f = _once(f, "book", "labels", "images")
    labels, images = f.select("book", F.explode("labels").alias("fig")), f.select("book", F.explode("images").alias("fig"))
    return figures.reconciled(labels, images, ["book", "fig"])


# --- configurations and identity --------------------------------------------------------------------------------------
@query
def config_keys(spark: SparkSession, d: str) -> DataFrame:
    return identity.parsed_configs(_once(_files(spark, d, "conf"), "content"), ["file_id"])


@query
def config_chapter_ranges(spark: SparkSession, d: str) -> DataFrame:
    f = _once(_files(spark, d, "conf"), "content")
    return f.select("file_id", F.explode(identity.config_ranges(F.col("content"))).alias("r")).select("file_id", "r.*").distinct()


def _current_confs(spark: SparkSession, d: str) -> DataFrame:
    c = latest(read(spark, d, "book_conf").select("book", "revision", "loaded_at", "conf"), ["book", "revision"], "loaded_at")
    return c.groupBy("book").agg(F.max_by("conf", "revision").alias("conf"))


@query
def identity_reasons(spark: SparkSession, d: str) -> DataFrame:
    c = _current_confs(spark, d)
    pages = read(spark, d, "chapter_range").groupBy("book").agg(F.max("end_page").alias("real_pages"))
    c = c.join(pages, "book", "left")
    return c.select("book", F.array_join(identity.reasons(F.col("conf"), F.col("real_pages") + 1), "; ").alias("reasons"))


@query
def identity_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: books of one noun claim one PDF, whose pages are the greatest count that one of them states."""
    c = _current_confs(spark, d).withColumn("source_pdf", F.concat(F.lit("./pdfs/"), F.regexp_extract("book", r"_([a-z-]+)_\d+$", 1), F.lit(".pdf")))
    stated = F.regexp_extract(F.col("conf")["PAGE_COUNT"], r"^\s*(\d+)\s*$", 1).try_cast("int")
    pdfs = c.groupBy(F.replace("source_pdf", F.lit("./"), F.lit("")).alias("pdf")).agg(F.max(stated).alias("real_pages"))
    claims = identity.claimants(c, pdfs).select("pdf", "book", (F.size(F.filter(identity.reasons(F.col("conf"), F.col("real_pages")), lambda r: ~r.startswith("missing:"))) == 0).alias("ok"))
    nobody = pdfs.select(F.concat(F.lit("other/"), F.col("pdf")).alias("pdf"))
    return identity.decisions(pdfs.select("pdf").unionByName(nobody), claims)


# --- contents and page ranges ----------------------------------------------------------------------------------------
def _ranges(spark: SparkSession, d: str) -> DataFrame:
    r = read(spark, d, "chapter_range").where("book is not null and chapter is not null")
    return latest(r, ["book", "chapter"], "loaded_at").drop("loaded_at")


@query
def page_chunks(spark: SparkSession, d: str) -> DataFrame:
    return toc.page_chunks(_ranges(spark, d), ["book", "chapter"], "start_page", "end_page")


@query
def page_ownership(spark: SparkSession, d: str) -> DataFrame:
    # neighbours share their border page here, so that overlaps exist
    r = _ranges(spark, d).withColumn("end_page", F.col("end_page") + 1)
    return toc.overlaps(r, "book", "chapter", "start_page", "end_page")


@query
def slugs(spark: SparkSession, d: str) -> DataFrame:
    return _ranges(spark, d).where("title is not null").select("book", "chapter", slug(F.concat(F.col("title"), F.when(F.col("chapter") % 3 == 0, F.lit(": A Survey with Notes")).otherwise(F.lit("")))).alias("slug"))


@query
def toc_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: each book's chapters as a printed table of contents in one of three styles, chosen by the book's name."""
    r = _ranges(spark, d).where("title is not null and start_page is not null")
    style = F.length("book") % 3
    line = (
        F.when(style == 0, F.format_string("Chapter %d %s .... %d", "chapter", "title", "start_page"))
        .when(style == 1, F.format_string("%d.  %s    %d", "chapter", "title", "start_page"))
        .otherwise(F.format_string("%d  %s  %d", "chapter", "title", "start_page"))
    )
    fronts = r.groupBy("book").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chapter", line.alias("l")))), lambda x: x["l"]), "\n").alias("text"), (F.max("start_page") + 20).alias("n_pages"))
    return toc.chapter_ranges(fronts)


@query
def first_lines(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", toc.first_line(F.col("text")).alias("title"))


@query
def front_text(spark: SparkSession, d: str) -> DataFrame:
    p = latest(read(spark, d, "ocr_page").where("pdf is not null and page_num <= 20").select("ocr_id", "pdf", "page_num", "text", "loaded_at"), ["ocr_id"], "loaded_at")
    t = toc.page_text(p, "pdf", "page_num", "text", first=toc.FRONT_PAGES)
    return t.select("pdf", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


@query
def text_layer(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "ocr_page").select("ocr_id", "pdf", "loaded_at", readers.page_chars(F.col("text")).alias("chars"))
    return readers.text_layer(latest(p, ["ocr_id"], "loaded_at"))


@query
def split_output(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: the sections of each chapter as one converted text with file markers."""
    f = _once(_files(spark, d, "tex").where("stem like 'sec%' and book is not null and chapter is not null and content is not null"), "book", "chapter", "stem", "content")
    marked = F.concat(F.lit("%%% FILE: "), F.col("stem"), F.lit(".tex %%%\n"), F.col("content"))
    t = f.groupBy("book", "chapter").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("stem", "file_id", marked.alias("m")))), lambda x: x["m"]), "\n").alias("t"))
    out = toc.split_files(t, ["book", "chapter"], "t", "chapter")
    return out.select("book", "chapter", "ord", "filename", F.length("content").cast("bigint").alias("chars"), F.md5("content").alias("content_md5"))


@query
def unconverted_chapters(spark: SparkSession, d: str) -> DataFrame:
    return toc.unconverted(_ranges(spark, d).select("book", "chapter"), _files(spark, d, "tex").where("stem is not null"))


# --- written texts -------------------------------------------------------------------------------------------------------
@query
def written_configs(spark: SparkSession, d: str) -> DataFrame:
    r = _ranges(spark, d).where("start_page is not null and end_page is not null").select("book", "chapter", "start_page", "end_page")
    n = F.lit(None).cast("string")
    books = r.select("book").distinct().select("book", F.initcap(F.replace("book", F.lit("_"), F.lit(" "))).alias("title"), n.alias("author"), F.lit("2nd").alias("edition"), n.alias("publisher"))
    return writers.config_text(books, r)


@query
def written_wrappers(spark: SparkSession, d: str) -> DataFrame:
    f = _files(spark, d, "tex").where("stem like 'sec%' and book is not null and chapter is not null").withColumn("first_page", checks.pages_header(F.col("content")))
    return writers.wrapper_text(_once(f, "book", "chapter", "stem", "first_page"), _ranges(spark, d))


@query
def written_progress(spark: SparkSession, d: str) -> DataFrame:
    r = _ranges(spark, d).where("start_page is not null and end_page is not null")
    done = _files(spark, d, "tex").where("stem like 'sec%'").select("book", "chapter").distinct().withColumn("d", F.lit(True))
    return writers.progress_table(r.join(done, ["book", "chapter"], "left").select("book", "chapter", "title", "start_page", "end_page", F.coalesce("d", F.lit(False)).alias("done")))


@query
def progress_shares(spark: SparkSession, d: str) -> DataFrame:
    """The written progress tables read again: done chapters per book and in all."""
    rows = progress.table_rows(written_progress(spark, d), ["book"], "text").where("cells[0] <> 'Chapter'")
    return progress.roll_up(rows.select("book", (F.element_at("cells", -1) == "[x]").alias("done")), ["book"])


@query
def check_lists(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: each chapter as a check list of two items under its title."""
    mark = F.when(F.col("chapter") % 2 == 0, "x").otherwise(" ")
    text = F.concat(F.lit("# "), F.col("title"), F.lit("\n- ["), mark, F.lit("] pages from "), F.col("start_page").cast("string"), F.lit("\nplain\n  * [X] chapter "), F.col("chapter").cast("string"), F.lit("\n- [?] none"))
    r = _ranges(spark, d).where("title is not null and start_page is not null").select("book", "chapter", text.alias("text"))
    return progress.check_list(r, ["book", "chapter"], "text")


@query
def missing_stubs(spark: SparkSession, d: str) -> DataFrame:
    """Chapters for which a stub is to be written: those without any file."""
    return writers.create_if_absent(_ranges(spark, d).select("book", "chapter"), _files(spark, d).where("book is not null and chapter is not null"), ["book", "chapter"])


@query
def progress_sources(spark: SparkSession, d: str) -> DataFrame:
    """Each book's most preferred file to read its progress from."""
    return results.first_present(_files(spark, d).where("book is not null"), ["book"], ["progress.md", "latex/ch01/ch01.tex", "book.conf"])


@query
def book_names(spark: SparkSession, d: str) -> DataFrame:
    """Which stems and paths of files could name a directory."""
    f = _files(spark, d).select("stem", "rel_path").distinct()
    names = f.select(F.explode(F.array("stem", "rel_path", F.concat("stem", F.lit("..")), F.lit(""))).alias("name"))
    return names.distinct().select("name", plain_name(F.col("name")).alias("plain"))


@query
def chapter_page_text(spark: SparkSession, d: str) -> DataFrame:
    """The scanned text of every chapter's pages."""
    p = latest(read(spark, d, "ocr_page").where("pdf is not null and page_num is not null").select("ocr_id", "pdf", "page_num", "text", "loaded_at"), ["ocr_id"], "loaded_at")
    spans = _ranges(spark, d).where("start_page is not null and end_page is not null").select(F.concat(F.lit("pdfs/"), F.col("book"), F.lit(".pdf")).alias("pdf"), "start_page", "end_page").distinct()
    t = toc.span_text(p, spans, "pdf", "page_num", "text")
    return t.select("pdf", "start_page", "end_page", F.length("text").cast("bigint").alias("chars"), F.md5("text").alias("text_md5"))


@query
def printed_pages(spark: SparkSession, d: str) -> DataFrame:
    p = latest(read(spark, d, "ocr_page").where("pdf is not null").select("ocr_id", "pdf", "page_num", "text", "loaded_at"), ["ocr_id"], "loaded_at")
    t = toc.printed_dump(p.select("ocr_id", "pdf", "page_num", "text"), "pdf", "page_num", "text", 11)
    return t.select("pdf", "page_num", F.length("piece").cast("bigint").alias("chars"), F.md5("piece").alias("piece_md5"))


# --- logs -----------------------------------------------------------------------------------------------------------------
def _log_lines(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: each user's events as a typesetting log."""
    e = read(spark, d, "events").where("user_id is not null and event_id is not null")
    n = F.col("event_id")
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("./ch0"), (n % 7).cast("string"), F.lit("/sec.tex:"), (n % 50).cast("string"), F.lit(": Undefined control sequence "), (n % 3).cast("string")))
        .when(F.col("event_type") == "click", F.concat(F.lit("! Missing $ inserted "), (n % 4).cast("string")))
        .when(F.col("event_type") == "view", F.concat(F.lit("(./ch0"), (n % 5).cast("string"), F.lit("/a.tex (./b"), (n % 3).cast("string"), F.lit(".sty")))
        .when(F.col("event_type") == "signup", F.concat(F.lit("l."), (n % 90).cast("string"), F.lit(" \\foo")))
        .otherwise(F.concat(F.lit("Overfull \\hbox "), (n % 10).cast("string")))
    )
    return e.select(F.col("user_id").alias("log_id"), F.col("event_id").alias("line_no"), line.alias("line"))


@query
def log_errors(spark: SparkSession, d: str) -> DataFrame:
    return logs.errors(_log_lines(spark, d))


@query
def log_errors_of_all(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: customers as runs; those without events left no log."""
    e = logs.errors_of_all(read(spark, d, "customer").select(F.col("c_custkey").alias("log_id")), _log_lines(spark, d))
    return e.groupBy((F.col("message") == "no log was written").alias("no_log")).agg(F.count("*").alias("errors"), F.countDistinct("log_id").alias("logs"))


@query
def log_error_files(spark: SparkSession, d: str) -> DataFrame:
    """The ten files most often named in errors; ``log_error_files_rest`` says what is beyond them."""
    return logs.top_files(logs.error_files(logs.errors(_log_lines(spark, d))), 10)


@query
def log_error_files_all(spark: SparkSession, d: str) -> DataFrame:
    """Distinct files named in errors."""
    return logs.error_files(logs.errors(_log_lines(spark, d)))


@query
def log_error_files_rest(spark: SparkSession, d: str) -> DataFrame:
    """How many files, and errors in them, are beyond the ten most frequent."""
    return logs.files_beyond(logs.error_files(logs.errors(_log_lines(spark, d))), 10)


@query
def wrap_width(spark: SparkSession, d: str) -> DataFrame:
    """Widths of scanned texts as if they were logs: every page that looks hard-wrapped."""
    p = latest(read(spark, d, "ocr_page").where("text is not null").select("ocr_id", "text", "loaded_at"), ["ocr_id"], "loaded_at")
    return logs.wrap_widths(p.select(F.col("ocr_id").alias("log_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")))


@query
def log_unwrapped(spark: SparkSession, d: str) -> DataFrame:
    """Scanned texts as if they were logs; equal rows of one page give equal lines, counted once."""
    p = read(spark, d, "ocr_page").where("text is not null").select(F.struct("ocr_id", "loaded_at", F.xxhash64("text").alias("h")).alias("log_id"), "text")
    out = logs.unwrapped_texts(p, "log_id", "text").select("log_id.*", "line_no", F.length("line").alias("n")).distinct()
    out = out.groupBy("ocr_id", "loaded_at", "h").agg(F.count("*").alias("lines"), F.max("n").alias("longest"))
    return latest(out, ["ocr_id"], "loaded_at").select(F.col("ocr_id").alias("log_id"), "lines", "longest")


@query
def relative_paths(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: paths as logs of three machines write them."""
    p = F.when(F.col("file_id") % 3 == 0, F.concat(F.lit("/work/tree/"), F.col("rel_path"))).when(F.col("file_id") % 3 == 1, F.concat(F.lit("\\work\\tree\\"), F.replace("rel_path", F.lit("/"), F.lit("\\")))).otherwise(F.concat(F.lit("./"), F.col("rel_path")))
    return _files(spark, d).select("file_id", logs.relative_path(p, "/work/tree/").alias("path")).distinct()


# --- figures --------------------------------------------------------------------------------------------------------------
def _caption_text(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: parts as pages with captions of all styles."""
    k = F.col("p_partkey")
    text = F.concat(
        F.lit("See Figure "), (k % 5 + 1).cast("string"), F.lit("."), (k % 13).cast("string"), F.lit(" and Figure  "), (k % 3).cast("string"), F.lit("."), (k % 4).cast("string"), F.lit("."), (k % 30).cast("string"),
        F.lit("; Figure "), F.element_at(F.array(*map(F.lit, ("I", "II", "III", "IV", "V"))), (k % 5 + 1).cast("int")), F.lit(" - "), (k % 20).cast("string"), F.when(k % 2 == 0, F.lit("a")).otherwise(F.lit("")),
    )
    return read(spark, d, "part").select(F.col("p_size").alias("book"), k.alias("page"), text.alias("text"))


@query
def captions_found(spark: SparkSession, d: str) -> DataFrame:
    t = _caption_text(spark, d)
    parts = [figures.captions(t, "text", s).select(F.lit(s).alias("style"), "page", "ord", "chapter", "fig_id") for s in ("two-part", "two-part-strict", "three-part", "roman")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("style", "page", "ord", "chapter", "fig_id", figures.image_path(F.col("chapter"), F.col("fig_id")).alias("path"))


@query
def first_captions(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: each part's text as the only box of a page scanned at 150 dots an inch."""
    k = F.col("page").cast("double")
    boxes = _caption_text(spark, d).withColumn("bbox", F.array(F.array(F.lit(0.0), k % 900), F.array(F.lit(9.0), k % 900), F.array(F.lit(9.0), k % 900 + 20), F.array(F.lit(0.0), k % 900 + 20)))
    parts = [figures.captions_in_boxes(boxes, s).select(F.lit(s).alias("style"), "page", "fig_id", F.round("caption_y", 6).alias("caption_y")) for s in ("two-part", "three-part", "roman")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def figures_first(spark: SparkSession, d: str) -> DataFrame:
    f = figures.captions(_caption_text(spark, d), "text", "three-part")
    return figures.first_of_each(f, ["book", "fig_id"], ["page", "ord"]).select("book", "fig_id", "chapter", "page")


@query
def figures_per_chapter(spark: SparkSession, d: str) -> DataFrame:
    f = figures.captions(_caption_text(spark, d), "text", "three-part")
    one = figures.first_of_each(f, ["book", "fig_id"], ["page", "ord"])
    return figures.per_chapter(one, ["book", "chapter"], ["page", "ord"])


def _geometry(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: an order's lines as blocks of a page 612 by 792, a caption by the order's key."""
    li = read(spark, d, "lineitem")
    b = li.select(
        F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("block_no"), (F.col("l_partkey") % 700).cast("double").alias("y0"), (F.col("l_partkey") % 700 + F.col("l_quantity")).alias("y1"),
        F.concat(F.when(F.col("l_linenumber") % 3 == 0, F.lit("Figure ")).otherwise(F.lit("")), F.repeat(F.lit("x"), (F.col("l_suppkey") % 90).cast("int"))).alias("text"),
    )
    return b.groupBy("page").agg(F.sort_array(F.collect_list(F.struct("block_no", "y0", "y1", "text"))).alias("blocks")).withColumn("caption_y", (F.col("page") % 640 + 100).cast("double"))


@query
def crop_rectangles(spark: SparkSession, d: str) -> DataFrame:
    g = _geometry(spark, d)
    w, h, y = F.lit(612.0), F.lit(792.0), F.col("caption_y")
    rects = {"text": figures.crop_by_text(F.col("blocks"), y, w, h), "ocr": figures.crop_by_ocr(y * 2, w), "nearest": figures.crop_by_nearest(F.col("blocks"), y, y + 12, w), "above": figures.crop_above(y, y + 12, w)}
    cols = [F.round(r[c], 6).alias(f"{n}_{c}") for n, r in rects.items() for c in ("y0", "y1")]
    return g.select("page", *cols)


@query
def nearest_blocks(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem")
    blocks = li.select(F.col("l_orderkey").alias("page"), (F.col("l_partkey") % 700 + F.col("l_quantity")).alias("y1"))
    caps = read(spark, d, "orders").select(F.col("o_orderkey").alias("page"), (F.col("o_orderkey") % 640 + 100).cast("double").alias("caption_y"))
    return figures.nearest_above(caps, blocks, ["page"], "caption_y", "y1", 10)


@query
def located_captions(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: lines of an order as spans of a page; captions are looked for in two spellings."""
    k = (F.col("l_partkey") % 5).cast("string")
    spans = read(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("page"), F.concat(F.lit("Figure "), k, F.when(F.col("l_suppkey") % 2 == 0, F.lit("-1")).otherwise(F.lit("–1"))).alias("span_text"), (F.col("l_linenumber").cast("bigint") * 1_000_000 + F.col("l_suppkey")).alias("ord"),
        *[(F.col("l_suppkey") % n).cast("double").alias(c) for n, c in ((7, "x0"), (11, "y0"), (13, "x1"), (17, "y1"))],
    )
    n = (F.col("o_custkey") % 5).cast("string")
    wanted = read(spark, d, "orders").select(F.col("o_orderkey").alias("page"), F.concat(F.lit("Figure "), n, F.lit("-1")).alias("caption"), F.concat(F.lit("Figure "), n, F.lit("–1")).alias("dashed"))
    out = figures.located(wanted, spans, ["page"], "caption", "dashed")
    return out.select("page", "caption", "rect.x0", "rect.y0", "rect.x1", "rect.y1")


# --- results ------------------------------------------------------------------------------------------------------------
@query
def results_summary(spark: SparkSession, d: str) -> DataFrame:
    return results.summary(read(spark, d, "filter_test_result"), ["suite", "model"])


@query
def result_errors(spark: SparkSession, d: str) -> DataFrame:
    r = latest(read(spark, d, "filter_test_result").select("result_id", "test_name", "error_message", "loaded_at"), ["result_id"], "loaded_at")
    return r.select("result_id", results.error_class(F.col("error_message")).alias("error_class"), results.holds_metadata(F.col("test_name")).alias("holds_metadata"))


@query
def suite_history(spark: SparkSession, d: str) -> DataFrame:
    """Carrier: results without a latency as the history, the others as a new run that lacks one column; one suite of both."""
    r = latest(read(spark, d, "filter_test_result").select("result_id", "suite", "model", "latency_ms", "loaded_at"), ["result_id"], "loaded_at").drop("loaded_at")
    both = results.appended(r.where("latency_ms is null").drop("latency_ms").withColumn("note", F.lit("old")), r.where("latency_ms is not null"))
    first = r.where("suite is not null").agg(F.min("suite")).first()[0]
    return results.selected(both, first)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(Q)


def oracle_sql() -> dict[str, str]:
    from quire.plans import oracles

    return oracles.SQL


__all__ = ["queries", "oracle_sql", "readers"]
