"""Structural checks on small trees."""

from pyspark.sql import functions as F

from quire.operators import checks, inventory


def _file(chapter, stem, content, book="b"):
    return (book, chapter, stem, f"latex/ch{chapter:02d}/{stem}.tex", content)


COLS = "book string, chapter int, stem string, rel_path string, content string"


def wrapper(spark, rows):
    return sorted((r.chapter, r.stem, r.code) for r in checks.wrapper_violations(spark.createDataFrame(rows, COLS)).collect())


def test_complete_chapter_is_clean(spark):
    assert wrapper(spark, [_file(1, "ch01", "\\input{ch01/sec01_1}\n\\include{ch01/sec01_2.tex}"), _file(1, "sec01_1", "a"), _file(1, "sec01_2", None)]) == []


def test_orphans_dangling_comments(spark):
    rows = [_file(1, "ch01", "% \\input{ch01/sec01_1}\n50\\% \\input{ch01/sec01_9}\n\\subfile{ shared }"), _file(1, "sec01_1", "a")]
    assert wrapper(spark, rows) == [(1, "sec01_1", "orphan"), (1, "sec01_9", "dangling")]


def test_no_wrapper_says_nothing_else_and_chapters_are_apart(spark):
    rows = [_file(1, "sec01_1", "a"), _file(1, "sec01_2", "a"), _file(2, "ch02", ""), _file(3, "ch03", "\\input{ch03/sec03_1}"), _file(3, "sec03_1", "x")]
    assert wrapper(spark, rows) == [(1, None, "no_wrapper"), (2, None, "empty")]


def test_reference_at_the_root_is_no_dangling(spark):
    rows = [_file(1, "ch01", "\\input{sec_notation}\\input{ch01/sec01_1}"), _file(1, "sec01_1", "a"), ("b", None, "sec_notation", "latex/sec_notation.tex", "x")]
    assert wrapper(spark, rows) == []


def balance(spark, files):
    df = spark.createDataFrame([("b", 1, s, c) for s, c in files], "book string, chapter int, stem string, content string")
    return [(r.name, r.code, r.env) for r in checks.balance_violations(df).orderBy("ord").collect()]


def test_balance_across_files_in_page_order(spark):
    files = [("sec01_2", "% PAGES: 1-2\n\\begin{proof}\n\\["), ("sec01_1", "% PAGES: 3-4\n\\]\n\\end{proof}"), ("sec01_0", None)]
    assert balance(spark, files) == []


def test_mismatch_does_not_pop(spark):
    files = [("s1", "\\begin{a}\\begin{b}\\end{a}\\end{b}\\end{a}"), ("s2", "\\end{c} \\] \\[ \\\\[0.5em]\n% \\end{d}\n\\begin{e*}")]
    assert balance(spark, files) == [("s1", "unmatched_end", "a"), ("s2", "unmatched_end", "c"), ("s2", "display_end", "\\]"), ("s2", "unclosed", "e*"), ("s2", "display_unclosed", "\\[")]


def test_markers_and_layout(spark):
    t = spark.createDataFrame([(1, "isbn 3"), (2, "disbnx Copyright 2020"), (3, "\\TextCopyright All RIGHTS reserved"), (4, None), (5, "the Library of Congress")], "id int, text string")
    got = sorted((r.id, r.marker) for r in checks.forbidden_markers(t, ["id"], "text").collect())
    assert got == [(1, "isbn"), (3, "all rights reserved"), (3, "textcopyright"), (5, "library of congress")]
    f = spark.createDataFrame([("b", "book.conf"), ("b", "book.conf"), ("b", "latex/main.tex"), (None, "progress.md")], "book string, rel_path string")
    assert sorted(r.rel_path for r in checks.missing_required(f).collect()) == ["latex/preamble.tex", "progress.md"]


def test_leftovers_and_inventory(spark):
    f = spark.createDataFrame([(1, "b", 1, "a\n% TODO x\n\\section{a}\\item\\itemsep\n\\begin{align*}"), (2, "b", 2, None), (3, "c", 1, "\\begin{figure}\\section*{x}")], "file_id int, book string, chapter int, content string")
    assert [(r.file_id, r.line_no) for r in checks.leftovers(f, ["file_id"], "content").collect()] == [(1, 2)]
    counts = inventory.element_counts(f)
    got = {(r.book, r.chapter, r.level): (r.sections, r.equations, r.figures, r.exercises) for r in inventory.rolled_up(counts, ["book", "chapter"], list(inventory.ELEMENTS)).collect()}
    assert got[("b", 1, 2)] == (1, 1, 0, 2) and got[("b", 2, 2)] == (0, 0, 0, 0) and got[(None, None, 0)] == (1, 1, 1, 2)


def test_top_terms_ties(spark):
    f = spark.createDataFrame([("\\beta \\alpha \\alphabet \\beta \\alpha \\gamma",), (None,)], "content string")
    assert [(r.term, r.n) for r in inventory.top_terms(f, "content", inventory.SYMBOLS, [], 2).collect()] == [("\\alpha", 2), ("\\beta", 2)]
    assert inventory.top_terms(spark.createDataFrame([], "content string"), "content", inventory.SYMBOLS, [], 2).count() == 0


def test_legacy_paths_and_books_without_files(spark):
    paths = spark.createDataFrame([("book.conf",), ("docs/progress.md",), ("latex/ch01/a.tex",), ("latex/ch01/b.tex",), ("latex/chX/c.tex",), ("latex/ch09.tex",), ("books/b/book.conf",), (None,)], "path string")
    assert sorted(map(tuple, checks.legacy_paths(paths).collect())) == [("book.conf", "file"), ("docs/progress.md", "file"), ("latex/ch01", "chapter_dir"), ("latex/chX", "chapter_dir")]
    assert checks.legacy_paths(paths.limit(0)).count() == 0
    files = spark.createDataFrame([("a", p) for p in checks.REQUIRED_FILES] + [(None, "book.conf")], "book string, rel_path string")
    books = spark.createDataFrame([("a",), ("b",), (None,)], "book string")
    assert {tuple(r) for r in checks.missing_required(files, books=books).collect()} == {("b", p) for p in checks.REQUIRED_FILES}
    rows = checks.all_violations(("layout", checks.missing_required(files, books=books), [F.col("book"), F.col("rel_path"), F.lit("missing")]))
    assert checks.of_book(rows, "b").count() == 4 and checks.of_book(rows, "a").count() == 0
