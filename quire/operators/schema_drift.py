"""Problem 1: schemas that drift between revisions, by tagged-union inference.

Every revision carries a ``MAP<STRING,STRING>`` whose keys and value forms drift. The parallel schemas are fused into
one: each canonical field keeps all the alternative types seen on its path (a tagged union), a conflict is split into
one typed branch per alternative plus one canonical conversion, and every alternative that appears, goes or is renamed
between two revisions is reported.

Defined cases
-------------
* a key of no known field is a field of its own, named by its words in upper snake case.
* null map, no known key, blank or quoted-blank value: the field is not held (all branches null).
* several known keys of one field in one revision: the first held one in preference order of its spelling
  (upper snake case, then by code point) is the field's key; the others are ignored.
* repeated (book, revision): the row with the latest ``loaded_at`` counts, null ``loaded_at`` is the earliest.
* null book: such rows form a book of their own; null revision: the row has no place in the order and is left out.
* empty table: empty results of the same schema. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.cluster import blocked_lag, latest

#: Canonical field -> pattern of its keys, over a key's words in lower snake case. Fixed values of this data's domain.
FIELDS = {
    "PAGE_COUNT": r"^(?:(?:n|nr|no|num|number|total|pdf|count)_(?:of_)?pages?|(?:total_|pdf_)?pages?_(?:count|total|num|number))$",
    "FIGURE_NUMBERING": r"^(?:fig|figs|figure|figures|caption|captions)_(?:numbering|numbers_style|number_style|style|scheme)$",
    "BACKMATTER_PAGES": r"^(?:back|end)_?(?:matter)?_(?:page|pages|range|page_range|pages_range)$",
}
TYPES = ("integer", "decimal", "boolean", "range", "list", "text")


def words(key: Column) -> Column:
    """Lower snake case of a key: ``PageCount``, ``Page-Count`` and ``PAGE_COUNT`` all give ``page_count``."""
    split = F.regexp_replace(key, r"([a-z0-9])([A-Z])", "$1_$2")
    return F.lower(F.regexp_replace(F.regexp_replace(split, r"[^A-Za-z0-9]+", "_"), r"^_+|_+$", ""))


def bare(value: Column) -> Column:
    """The value without quotes and blanks around it; null if nothing is left."""
    return F.nullif(F.regexp_replace(value, r"""^[\s"' ]+|[\s"' ]+$""", ""), F.lit(""))


def value_type(v: Column) -> Column:
    """Tag of a bare value. A bracketed list of numbers is a list too."""
    return (
        F.when(v.isNull(), None)
        .when(v.rlike(r"^[0-9]+$"), "integer")
        .when(v.rlike(r"^[0-9]+\.[0-9]+$"), "decimal")
        .when(v.rlike(r"^(?:true|false)$"), "boolean")
        .when(v.rlike(r"^[0-9]+\s*[-‐-―−]+\s*[0-9]+$"), "range")
        .when(v.rlike(r"^\[?\s*[0-9]+(?:\s*,\s*[0-9]+)+\s*\]?$"), "list")
        .otherwise("text")
    )


def _best(held: Column, field: str, pattern: str) -> Column:
    """The held key of a field: its preferred spelling first, then by code point (structs order by their members)."""
    mine = F.filter(held, lambda e: e["w"].rlike(pattern))
    return F.array_min(F.transform(mine, lambda e: F.struct((e["key"] != F.lit(field)).alias("o"), e["key"].alias("key"), e["v"].alias("v"))))


def revisions(conf: DataFrame) -> DataFrame:
    """(book, revision, loaded_at, committed_at, f): ``f`` maps a canonical field to (key, raw, type)."""
    rows = conf.where(F.col("revision").isNotNull()).select("book", "revision", "committed_at", "loaded_at", "conf")
    rows = latest(rows, ["book", "revision"], "loaded_at")
    held = F.filter(
        F.transform(F.coalesce(F.map_entries("conf"), F.array()), lambda e: F.struct(e["key"].alias("key"), words(e["key"]).alias("w"), bare(e["value"]).alias("v"))),
        lambda e: e["v"].isNotNull(),
    )
    rows = rows.withColumn("__held", held)
    for field, pattern in FIELDS.items():
        best = _best(F.col("__held"), field, pattern)
        rows = rows.withColumn(field, F.when(best.isNotNull(), F.struct(best["key"].alias("key"), best["v"].alias("raw"), value_type(best["v"]).alias("type"))))
    return rows.drop("__held", "conf")


def _field(key_words: Column) -> Column:
    """Canonical field of a key given by its words: a known one, or one of its own."""
    known = F.coalesce(*[F.when(key_words.rlike(p), F.lit(f)) for f, p in FIELDS.items()], F.upper(key_words))
    return F.nullif(known, F.lit(""))


def values(conf: DataFrame) -> DataFrame:
    """(book, revision, field, key, type, value): every key of every revision in one consistent table, whatever it is. All
    of a revision's fields are made in its own row."""
    rows = conf.where(F.col("revision").isNotNull()).select("book", "revision", "loaded_at", "conf")
    rows = latest(rows, ["book", "revision"], "loaded_at")
    held = F.transform(F.coalesce(F.map_entries("conf"), F.array()), lambda e: F.struct(_field(words(e["key"])).alias("field"), e["key"].alias("key"), bare(e["value"]).alias("v")))
    rows = rows.select("book", "revision", F.filter(held, lambda e: e["v"].isNotNull() & e["field"].isNotNull()).alias("held"))
    best = lambda f: F.array_min(F.transform(F.filter("held", lambda e: e["field"] == f), lambda e: F.struct((e["key"] != f).alias("o"), e["key"].alias("key"), e["v"].alias("v"))))
    one = F.transform(F.array_distinct(F.transform("held", lambda e: e["field"])), lambda f: F.struct(f.alias("field"), best(f).alias("b")))
    rows = rows.select("book", "revision", F.explode(one).alias("x"))
    return rows.select("book", "revision", "x.field", F.col("x.b.key").alias("key"), value_type(F.col("x.b.v")).alias("type"), F.col("x.b.v").alias("value"))


def all_changes(conf: DataFrame) -> DataFrame:
    """(book, revision, field, change) as ``changes`` has them, of every field."""
    rows = values(conf).groupBy("book", "revision").agg(F.map_from_entries(F.collect_list(F.struct("field", F.struct("key", "type")))).alias("now"))
    every = latest(conf.where(F.col("revision").isNotNull()).select("book", "revision", "loaded_at"), ["book", "revision"], "loaded_at").select(F.col("book").alias("b"), F.col("revision").alias("r"))
    rows = every.join(rows, F.col("b").eqNullSafe(F.col("book")) & (F.col("r") == F.col("revision")), "left")
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<struct<key:string,type:string>>"))
    rows = rows.select(F.col("b").alias("book"), F.col("r").alias("revision"), F.coalesce("now", none).alias("now"))
    rows = blocked_lag(rows, ["book"], "revision", F.col("now"), "old").where("old is not null")
    rows = rows.select("book", "revision", "now", "old", F.explode(F.array_union(F.map_keys("now"), F.map_keys("old"))).alias("field"))
    a, b = F.try_element_at("old", F.col("field")), F.try_element_at("now", F.col("field"))
    both = a.isNotNull() & b.isNotNull()
    case = F.array(F.when(a.isNull(), "added"), F.when(b.isNull(), "removed"), F.when(both & (a["key"] != b["key"]), "renamed"), F.when(both & (a["type"] != b["type"]), "retyped"))
    return rows.select("book", "revision", "field", F.explode(F.array_compact(case)).alias("change"))


def _ints(v: Column) -> Column:
    return F.transform(F.regexp_extract_all(v, F.lit(r"([0-9]+)"), F.lit(1)), lambda x: x.try_cast("int"))


def consistent_table(conf: DataFrame) -> DataFrame:
    """One row per book and revision: per field the key it stood under, its type tag, one column per typed branch and
    a canonical conversion (page count as an integer, numbering as one of a few words, back matter as first and last
    page). Numbers beyond INT give null in the typed branch and stay in the text branch."""
    rows = revisions(conf)
    out = [F.col("book"), F.col("revision"), F.col("committed_at")]
    for field in FIELDS:
        n, v, t = field.lower(), F.col(field)["raw"], F.col(field)["type"]
        num = F.regexp_extract(v, r"([0-9]+)", 1).try_cast("int")
        out += [
            F.col(field)["key"].alias(f"{n}_key"),
            t.alias(f"{n}_type"),
            F.when(t == "integer", v.try_cast("int")).alias(f"{n}_integer"),
            F.when(t == "decimal", v.try_cast("double")).alias(f"{n}_decimal"),
            F.when(t == "boolean", v == "true").alias(f"{n}_boolean"),
            F.when(t == "range", F.concat_ws("-", F.transform(_ints(v), lambda x: x.cast("string")))).alias(f"{n}_range"),
            F.when(t == "list", F.concat_ws(",", F.transform(_ints(v), lambda x: x.cast("string")))).alias(f"{n}_list"),
            F.when(t == "text", v).alias(f"{n}_text"),
        ]
        if field == "PAGE_COUNT":
            out.append(num.alias("page_count"))
        elif field == "FIGURE_NUMBERING":
            style = F.when(v.isin("0", "false"), "none").when(v == "1", "one-part").when(v.isin("2", "true"), "two-part").when(v == "3", "three-part")
            out.append(F.coalesce(style, v).alias("figure_numbering"))
        else:
            pages = F.filter(_ints(v), lambda x: x.isNotNull())
            out += [F.array_min(pages).alias("backmatter_first"), F.array_max(pages).alias("backmatter_last")]
    return rows.select(*out)


def fused_schema(conf: DataFrame) -> DataFrame:
    """The fused tagged union: one row per field, key and type with its number of revisions and of books and the first
    and last revision number at which the alternative stands. Keys of no known field are there as fields of their own."""
    per_book = values(conf).groupBy("field", "key", "type", "book").agg(F.count("*").alias("n"), F.min("revision").alias("lo"), F.max("revision").alias("hi"))
    return per_book.groupBy("field", "key", "type").agg(
        F.sum("n").alias("revisions"), F.count("*").alias("books"), F.min("lo").alias("first_revision"), F.max("hi").alias("last_revision")
    )


def changes(conf: DataFrame) -> DataFrame:
    """(book, revision, field, change): every revision against the next lower one present of its book."""
    rows = revisions(conf)
    now = F.struct(*[F.struct(F.col(f)["key"].alias("key"), F.col(f)["type"].alias("type")).alias(f) for f in FIELDS])
    rows = rows.select("book", "revision", now.alias("now"))
    rows = blocked_lag(rows, ["book"], "revision", F.col("now"), "old").where("old is not null")
    cases = []
    for f in FIELDS:
        a, b = F.col("old")[f], F.col("now")[f]
        both = a["key"].isNotNull() & b["key"].isNotNull()
        for name, test in (
            ("added", a["key"].isNull() & b["key"].isNotNull()),
            ("removed", a["key"].isNotNull() & b["key"].isNull()),
            ("renamed", both & (a["key"] != b["key"])),
            ("retyped", both & (a["type"] != b["type"])),
        ):
            cases.append(F.when(test, F.struct(F.lit(f).alias("field"), F.lit(name).alias("change"))))
    rows = rows.select("book", "revision", F.explode(F.array_compact(F.array(*cases))).alias("c"))
    return rows.select("book", "revision", "c.field", "c.change")
