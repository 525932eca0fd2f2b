"""Configuration files and the decision whether a book goes on, begins or must stop.

Null contents hold no key. Keys that stand twice keep their last value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import lines

#: Keys that later work reads. Fixed values.
REQUIRED_KEYS = ("PAGE_OFFSET", "COPYRIGHT_PAGE", "FIGURE_NUMBERING", "BACKMATTER_PAGES")
LINE = r"^\s*([A-Z0-9_]+)\s*=\s*(.*?)\s*$"


def unquoted(value: Column) -> Column:
    """The value without one pair of equal quotes around it."""
    return F.when(value.rlike(r"""^(?s)(?:".*"|'.*')$""") & (F.length(value) >= 2), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def config_entries(content: Column) -> Column:
    """Array of (line_no, key, value) of the assignments in a configuration text."""
    rows = F.transform(lines(content), lambda x, i: F.struct((i + 1).alias("line_no"), F.regexp_extract(x, LINE, 1).alias("key"), F.regexp_extract(x, LINE, 2).alias("value"), (~x.rlike(r"^\s*#") & x.rlike(LINE)).alias("ok")))
    return F.transform(F.filter(rows, lambda r: r["ok"]), lambda r: F.struct(r["line_no"].alias("line_no"), r["key"].alias("key"), unquoted(r["value"]).alias("value")))


def parsed_configs(files: DataFrame, keys: list[str], content: str = "content") -> DataFrame:
    """(keys, key, value): long form; the last of a file's equal keys counts."""
    rows = files.select(*keys, F.explode(config_entries(F.col(content))).alias("e")).select(*keys, "e.*")
    return rows.groupBy(*keys, "key").agg(F.max_by("value", "line_no").alias("value"))


def config_ranges(content: Column) -> Column:
    """Array of (chapter, start_page, end_page) of the ``CHnn_PAGES="a-b"`` settings in a text."""
    groups = [F.regexp_extract_all(content, F.lit(r'CH(\d+)_PAGES="(\d+)-(\d+)"'), F.lit(i)).alias(n) for i, n in ((1, "c"), (2, "s"), (3, "e"))]
    return F.transform(F.arrays_zip(*groups), lambda x: F.struct(x["c"].try_cast("int").alias("chapter"), x["s"].try_cast("int").alias("start_page"), x["e"].try_cast("int").alias("end_page")))


def reasons(conf: Column, real_pages: Column) -> Column:
    """Why a configuration does not prove to be the book of so many pages; an empty array if it does."""
    held = F.map_filter(F.coalesce(conf, F.create_map().cast("map<string,string>")), lambda k, v: F.trim(v) != "")
    raw = F.trim(F.try_element_at(held, F.lit("PAGE_COUNT")))
    recorded = raw.try_cast("int")
    count = (
        F.when(raw.isNull(), "no_page_count")
        .when(recorded.isNull() | ~raw.rlike(r"^[+-]?[0-9]+$"), F.concat(F.lit("page_count_not_integer:"), raw))
        .when(~recorded.eqNullSafe(real_pages), F.concat(F.lit("different_book:"), raw, F.lit("<>"), F.coalesce(real_pages.cast("string"), F.lit("?"))))
    )
    missing = F.array_except(F.array(*map(F.lit, REQUIRED_KEYS)), F.map_keys(held))
    ranged = F.exists(F.map_keys(F.coalesce(conf, F.create_map().cast("map<string,string>"))), lambda k: k.rlike(r"^CH[0-9]+_PAGES$"))
    missing = F.sort_array(F.concat(missing, F.when(ranged, F.array().cast("array<string>")).otherwise(F.array(F.lit("CHNN_PAGES")))))
    return F.array_compact(F.array(count, F.when(F.size(missing) > 0, F.concat(F.lit("missing:"), F.array_join(missing, ",")))))


def claimants(confs: DataFrame, pdfs: DataFrame, claim: str = "source_pdf", pdf: str = "pdf") -> DataFrame:
    """Configurations whose named PDF is the given one, paths compared without ``./`` and with forward slashes."""
    norm = lambda c: F.regexp_replace(F.replace(c, F.lit("\\"), F.lit("/")), r"^(?:\./)+|/(?:\./)+", "")
    return confs.withColumn("__p", norm(F.col(claim))).join(pdfs.withColumn("__p", norm(F.col(pdf))), "__p").drop("__p")


def decisions(pdfs: DataFrame, claims: DataFrame, pdf: str = "pdf", book: str = "book") -> DataFrame:
    """(pdf, decision, book, claimants, verified): FRESH without a claimant, RESUME with exactly one verified, else STOP.
    ``claims`` holds (pdf, book, ok). Conditional aggregates with map-side combine."""
    agg = claims.groupBy(pdf).agg(F.count("*").alias("claimants"), F.count_if("ok").alias("verified"), F.max(F.when(F.col("ok"), F.col(book))).alias("__book"))
    out = pdfs.select(pdf).distinct().join(agg, pdf, "left").fillna(0, ["claimants", "verified"])
    decision = F.when(F.col("claimants") == 0, "FRESH").when(F.col("verified") == 1, "RESUME").otherwise("STOP")
    return out.select(pdf, decision.alias("decision"), F.when(decision == "RESUME", F.col("__book")).alias(book), "claimants", "verified")
