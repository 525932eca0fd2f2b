"""Structural checks as joins and folds; every check gives rows of (scope, object, code, detail).

Null keys never match; texts that are null hold no marker, reference or token.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import int_of, lines, stripped, without_comments

#: Markers that must not stand in a text. Fixed values.
FORBIDDEN = (
    ("isbn", r"(?i)\bISBN\b"),
    ("all rights reserved", r"(?i)all rights reserved"),
    ("library of congress", r"(?i)library of congress"),
    ("textcopyright", r"(?i)\\textcopyright"),
    ("copyright command", r"(?i)\\copyright"),
)
#: Files that every book must have; suffixes that hold text. Fixed values.
REQUIRED_FILES = ("book.conf", "progress.md", "latex/main.tex", "latex/preamble.tex")
TEXT_SUFFIXES = ("tex", "md", "conf", "txt", "bib")
NO_PAGES = 10**9


def forbidden_markers(texts: DataFrame, keys: list[str], text: str, markers=FORBIDDEN) -> DataFrame:
    """One row per text and marker in it. The patterns are literals of one projection: no join, one pass over a text."""
    hit = F.array_compact(F.array(*[F.when(F.col(text).rlike(p), F.lit(n)) for n, p in markers]))
    return texts.select(*keys, F.explode(hit).alias("marker"))


def missing_required(files: DataFrame, required: tuple[str, ...] = REQUIRED_FILES, books: DataFrame | None = None) -> DataFrame:
    """(book, rel_path) that a book lacks. Each book's few required paths are gathered, so a book of any size is one row
    after the partial aggregate. ``books`` names books that may have no file at all."""
    files = files.select("book", "rel_path")
    if books is not None:
        files = files.unionByName(books.select("book", F.lit(None).cast("string").alias("rel_path")))
    have = files.where(F.col("book").isNotNull()).groupBy("book").agg(F.collect_set(F.when(F.col("rel_path").isin(*required), F.col("rel_path"))).alias("have"))
    return have.select("book", F.explode(F.array_except(F.array(*map(F.lit, required)), "have")).alias("rel_path"))


def leftovers(texts: DataFrame, keys: list[str], text: str, pattern: str = r"UNCLEAR|TODO") -> DataFrame:
    """(keys, line_no, line) of the lines that hold ``pattern``; lines are only exploded where the text holds it at all."""
    hit = texts.where(F.col(text).rlike(pattern)).select(*keys, F.posexplode(lines(F.col(text))).alias("line_no", "line"))
    return hit.where(F.col("line").rlike(pattern)).withColumn("line_no", F.col("line_no") + 1)


def legacy_paths(paths: DataFrame, path: str = "path") -> DataFrame:
    """(path, code) that an older layout left at the root of the tree: a configuration, a progress file, chapter
    directories (one row each, named without what lies in it). The books need not exist."""
    p = F.col(path)
    chapter = F.nullif(F.regexp_extract(p, r"^(latex/ch[^/]*)/", 1), F.lit(""))
    left = F.when(p.isin("book.conf", "docs/progress.md"), p).otherwise(chapter)
    return paths.select(left.alias("path")).where("path is not null").distinct().select("path", F.when(F.col("path").startswith("latex/"), "chapter_dir").otherwise("file").alias("code"))


def of_book(violations: DataFrame, book: str) -> DataFrame:
    """The violations of one book, of a union of checks."""
    return violations.where(F.col("scope") == book)


# --- references ---------------------------------------------------------------------------------------------------
def referenced_stems(content: Column) -> Column:
    """Stems that a wrapper includes: comments do not count, directories and ``.tex`` are dropped."""
    found = F.regexp_extract_all(without_comments(content), F.lit(r"\\(?:input|include|subfile)\s*\{([^}]*)\}"), F.lit(1))
    stem = F.transform(found, lambda t: F.regexp_replace(F.element_at(F.split(F.replace(stripped(t), F.lit("\\"), F.lit("/")), "/"), -1), r"\.tex$", ""))
    return F.array_distinct(F.filter(stem, lambda s: s != ""))


def wrapper_violations(files: DataFrame) -> DataFrame:
    """Wrapper integrity of (book, chapter, stem, rel_path, content) rows.

    ``orphan``: a section file that its wrapper does not include; ``dangling``: an included section that has no file in
    the chapter nor at the book's root; ``no_wrapper``: sections without a wrapper (nothing else is said of that
    chapter); ``empty``: a wrapper without sections. Only stems and lists of stems are shuffled, never contents."""
    f = files.where("book is not null and chapter is not null and stem is not null")
    name = F.concat(F.lit("ch"), F.lpad(F.col("chapter").cast("string"), 2, "0"))
    sections = f.where(F.col("stem").startswith("sec") & F.col("rel_path").contains("/ch")).select("book", "chapter", "stem").distinct()
    wrappers = f.where(F.col("stem") == name).select("book", "chapter", F.coalesce(referenced_stems(F.col("content")), F.array()).alias("refs"))
    wrappers = wrappers.groupBy("book", "chapter").agg(F.array_distinct(F.flatten(F.collect_set("refs"))).alias("refs"))
    refs = wrappers.select("book", "chapter", F.explode("refs").alias("stem"))
    root = files.where(~F.col("rel_path").contains("/ch")).select("book", "stem").where("stem is not null").distinct()
    covered = sections.join(wrappers.select("book", "chapter"), ["book", "chapter"], "left_semi")
    orphan = covered.join(refs, ["book", "chapter", "stem"], "left_anti").select("book", "chapter", "stem", F.lit("orphan").alias("code"))
    dangling = (
        refs.where(F.col("stem").startswith("sec"))
        .join(sections, ["book", "chapter", "stem"], "left_anti")
        .join(root, ["book", "stem"], "left_anti")
        .select("book", "chapter", "stem", F.lit("dangling").alias("code"))
    )
    chapters = sections.select("book", "chapter").distinct()
    none = F.lit(None).cast("string").alias("stem")
    lone = chapters.join(wrappers, ["book", "chapter"], "left_anti").select("book", "chapter", none, F.lit("no_wrapper").alias("code"))
    empty = wrappers.join(chapters, ["book", "chapter"], "left_anti").select("book", "chapter", none, F.lit("empty").alias("code"))
    return orphan.unionByName(dangling).unionByName(lone).unionByName(empty)


# --- balance ------------------------------------------------------------------------------------------------------
def pages_header(content: Column) -> Column:
    """First page number of a ``% PAGES:`` header on the first line; files without one come last."""
    return F.coalesce(int_of(F.element_at(F.split(content, "\n"), 1), r"% PAGES:\s*(\d+)"), F.lit(NO_PAGES))


def balance_tokens(content: Column) -> Column:
    """``\\begin{..}``, ``\\end{..}``, ``\\[`` and ``\\]`` in order, outside of comment lines."""
    body = F.array_join(F.filter(lines(content), lambda x: ~x.rlike(r"^\s*%")), "\n")
    return F.regexp_extract_all(body, F.lit(r"\\(?:begin|end)\{\w+\*?\}|(?<!\\)\\\[|(?<!\\)\\\]"), F.lit(0))


_STATE = "struct<stack:array<struct<env:string,name:string>>,out:array<struct<name:string,code:string,env:string>>,depth:int,owner:string>"


def balance_violations(files: DataFrame) -> DataFrame:
    """(book, chapter, name, code, env): environments and display mathematics that do not pair within a chapter.

    Files of a chapter are read in order of their page header, then name, then text. A mismatched end is reported and
    leaves the stack as it is; display mathematics are counted apart, underflow resets the count. The fold runs over a
    chapter's tokens in one row: only tokens are gathered, a chapter's own size bounds them."""
    per = files.where("book is not null and chapter is not null").select(
        "book", "chapter", F.struct(pages_header(F.col("content")).alias("p"), F.col("stem").alias("name"), F.coalesce(balance_tokens(F.col("content")), F.array().cast("array<string>")).alias("toks")).alias("f")
    )
    per = per.groupBy("book", "chapter").agg(F.sort_array(F.collect_list("f")).alias("fs"))
    toks = F.flatten(F.transform("fs", lambda f: F.transform(f["toks"], lambda t: F.struct(f["name"].alias("name"), t.alias("t")))))
    name, tok = "x.name", "x.t"
    fold = f"""
    aggregate(toks, cast(named_struct('stack', array(), 'out', array(), 'depth', 0, 'owner', null) as {_STATE}),
      (s, x) -> cast(case
        when {tok} = '\\\\[' then named_struct('stack', s.stack, 'out', s.out, 'depth', s.depth + 1, 'owner', if(s.depth = 0, {name}, s.owner))
        when {tok} = '\\\\]' and s.depth > 0 then named_struct('stack', s.stack, 'out', s.out, 'depth', s.depth - 1, 'owner', s.owner)
        when {tok} = '\\\\]' then named_struct('stack', s.stack, 'out', concat(s.out, array(named_struct('name', {name}, 'code', 'display_end', 'env', '\\\\]'))), 'depth', 0, 'owner', s.owner)
        when {tok} like '%begin{{%' then named_struct('stack', concat(s.stack, array(named_struct('env', regexp_extract({tok}, '\\\\{{(.*)\\\\}}', 1), 'name', {name}))), 'out', s.out, 'depth', s.depth, 'owner', s.owner)
        when size(s.stack) > 0 and element_at(s.stack, -1).env = regexp_extract({tok}, '\\\\{{(.*)\\\\}}', 1) then named_struct('stack', slice(s.stack, 1, size(s.stack) - 1), 'out', s.out, 'depth', s.depth, 'owner', s.owner)
        else named_struct('stack', s.stack, 'out', concat(s.out, array(named_struct('name', {name}, 'code', 'unmatched_end', 'env', regexp_extract({tok}, '\\\\{{(.*)\\\\}}', 1)))), 'depth', s.depth, 'owner', s.owner)
      end as {_STATE}),
      s -> concat(s.out, transform(s.stack, e -> named_struct('name', e.name, 'code', 'unclosed', 'env', e.env)),
                  if(s.depth > 0, array(named_struct('name', s.owner, 'code', 'display_unclosed', 'env', '\\\\[')), cast(array() as array<struct<name:string,code:string,env:string>>))))
    """
    out = per.select("book", "chapter", toks.alias("toks")).select("book", "chapter", F.posexplode(F.expr(fold)).alias("ord", "v"))
    return out.select("book", "chapter", "ord", "v.name", "v.code", "v.env")


def all_violations(*checks: tuple[str, DataFrame, list[Column]]) -> DataFrame:
    """The union of checks as (check, scope, object, code): each given as its name, its rows, and three columns."""
    parts = [df.select(F.lit(n).alias("check"), *[c.cast("string").alias(a) for c, a in zip(cols, ("scope", "object", "code"))]) for n, df, cols in checks]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
