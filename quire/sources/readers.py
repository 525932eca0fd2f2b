"""Readers of book trees, logs, configurations and result files into tables.

All paths go to Spark's file sources, so listing, splits and pruning are the cluster's; nothing is opened on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quire.functions.text import int_of, utf8_text
from quire.operators.identity import config_ranges, parsed_configs

RESULT_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("test_name", "suite", "model", "prompt_framing", "page_range")]
    + [T.StructField("num_pages", T.IntegerType()), T.StructField("includes_metadata", T.BooleanType())]
    + [T.StructField(n, T.StringType()) for n in ("input_format", "status", "error_message")]
    + [T.StructField("output_length", T.IntegerType()), T.StructField("latency_ms", T.IntegerType()), T.StructField("timestamp", T.StringType())]
)
PAGE_SCHEMA = T.StructType([
    T.StructField("pdf", T.StringType()), T.StructField("page_num", T.IntegerType()), T.StructField("width", T.DoubleType()), T.StructField("height", T.DoubleType()), T.StructField("text", T.StringType()),
    T.StructField("blocks", T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in ("x0", "y0", "x1", "y1")] + [T.StructField("text", T.StringType()), T.StructField("block_no", T.IntegerType()), T.StructField("block_type", T.IntegerType())]))),
])
#: Build products that an import leaves out. Fixed values.
BUILD_SUFFIXES = ("aux", "log", "out", "toc", "lof", "lot", "bbl", "blg", "synctex.gz", "fls", "fdb_latexmk", "pyc")


def located(df: DataFrame, path: Column, root: str) -> DataFrame:
    """book, rel_path, chapter, stem, suffix and ordinal (preamble 0, chapters 1, back matter 2) from a path below ``root``."""
    base = root.rstrip("/") + "/"
    rel = F.element_at(F.split(path, r"\Q" + base + r"\E", 2), -1)
    inner = F.regexp_replace(rel, r"^[^/]+/", "")
    name = F.element_at(F.split(rel, "/"), -1)
    return df.select(
        "*",
        F.element_at(F.split(rel, "/"), 1).alias("book"),
        inner.alias("rel_path"),
        int_of(inner, r"(?:^|/)ch(\d+)(?:/|\.)").alias("chapter"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"),
        F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("suffix"),
        F.when(inner.rlike(r"(?:^|/)preamble\.tex$"), 0).when(inner.rlike(r"(?:^|/)ch\d+/"), 1).when(inner.rlike(r"(?:^|/)backmatter/"), 2).otherwise(3).alias("ordinal"),
    )


def read_tree(spark: SparkSession, root: str, pattern: str = "*.tex", books: str = "*") -> DataFrame:
    """Files below ``root/<book>/`` whose names match ``pattern``, one row each: text by UTF-8 with replacement, line ends
    as ``\\n``. Pattern and book glob prune the listing, not rows."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(f"{root.rstrip('/')}/{books}")
    clean = located(raw.select("path", "content"), F.col("path"), root)
    return clean.select("path", "book", "rel_path", "chapter", "stem", "suffix", "ordinal", utf8_text(F.col("content")).alias("content"))


def source_files(tree: DataFrame, chapter: int | None = None) -> DataFrame:
    """The files a repair reads: preamble, chapters, back matter; with ``chapter`` that chapter's files alone."""
    if chapter is not None:
        return tree.where((F.col("ordinal") == 1) & (F.col("chapter") == chapter))
    return tree.where(F.col("ordinal") < 3)


def text_files(tree: DataFrame) -> DataFrame:
    """Files with text suffixes, letter case aside, without build products."""
    from quire.operators.checks import TEXT_SUFFIXES

    return tree.where(F.col("suffix").isin(*TEXT_SUFFIXES) & ~F.col("suffix").isin(*BUILD_SUFFIXES))


def chapters(tree: DataFrame, strict: bool = False) -> DataFrame:
    """Distinct (book, chapter); ``strict`` takes two-digit directories only."""
    rows = tree.where(F.col("rel_path").rlike(r"(?:^|/)ch[0-9][0-9]/")) if strict else tree.where(F.col("chapter").isNotNull())
    return rows.select("book", "chapter").distinct()


def sections(tree: DataFrame, strict: bool = False) -> DataFrame:
    """Section files: any ``sec*``, or with ``strict`` those named by their two-digit chapter."""
    if strict:
        return tree.where(F.col("stem").startswith(F.concat(F.lit("sec"), F.lpad(F.col("chapter").cast("string"), 2, "0"), F.lit("_"))))
    return tree.where(F.col("stem").startswith("sec") & F.col("chapter").isNotNull())


def read_logs(spark: SparkSession, path: str) -> DataFrame:
    """(log_id, line_no, line) of log files."""
    raw = spark.read.format("binaryFile").load(path).select(F.col("path").alias("log_id"), utf8_text(F.col("content")).alias("t"))
    return raw.select("log_id", F.posexplode(F.split("t", "\n", -1)).alias("line_no", "line"))


def read_configs(spark: SparkSession, root: str) -> DataFrame:
    """(book, key, value) of every ``book.conf``."""
    return parsed_configs(read_tree(spark, root, "book.conf"), ["book"])


def read_config_ranges(spark: SparkSession, root: str) -> DataFrame:
    tree = read_tree(spark, root, "book.conf")
    return tree.select("book", F.explode(config_ranges(F.col("content"))).alias("r")).select("book", "r.*")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """Result records from JSON arrays."""
    return spark.read.schema(RESULT_SCHEMA).option("multiLine", "true").json(path)


def page_chars(text: Column) -> Column:
    """Characters of a page without the blanks at its ends, 0 for none: all that the text layer needs of it."""
    return F.coalesce(F.length(F.regexp_replace(text, r"^\s+|\s+$", "")), F.lit(0)).cast("bigint")


def text_layer(pages: DataFrame, key: str = "pdf", chars: str = "chars") -> DataFrame:
    """(key, pages, text_chars, needs_ocr): a document whose pages hold no character but blanks has no text layer. ``chars``
    holds ``page_chars`` of each page."""
    n = F.sum(chars)
    return pages.groupBy(key).agg(F.count("*").alias("pages"), n.alias("text_chars"), (n == 0).alias("needs_ocr"))
