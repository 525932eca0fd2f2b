"""Schemas that drift: key spellings, value types, changes between revisions, odd rows."""

from datetime import datetime

from pyspark.sql import functions as F

from quire.functions.cluster import blocked_lag, latest
from quire.operators import schema_drift as S

COLS = "book string, revision int, committed_at timestamp, loaded_at timestamp, conf map<string,string>, word string, type string"
T0, T1 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def conf(spark, *rows):
    return spark.createDataFrame([(b, r, None, t, c, "w", "t") for b, r, t, c in rows], COLS)


def test_types(spark):
    cases = {
        "12": "integer", "007": "integer", "12.0": "decimal", "true": "boolean", "false": "boolean", "True": "text", "3-9": "range", "3--9": "range", "3 – 9": "range",
        "1,2": "list", "[1, 2, 3]": "list", "12 pages": "text", "-3": "text", "1.": "text", "two-part": "text", " '12' ": "integer", '"3-4"': "range",
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.t for r in df.select("v", S.value_type(S.bare(F.col("v"))).alias("t")).collect()}
    assert got == cases
    empty = spark.createDataFrame([("",), (" ",), ('""',), ("' '",), (None,)], "v string")
    assert all(r[0] is None for r in empty.select(S.bare(F.col("v"))).collect())


def test_key_spellings(spark):
    known = {"PAGE_COUNT": ["page_count", "PageCount", "N_PAGES", "NUM_PAGES", "TOTAL_PAGES", "PDF_PAGES", "Page-Count"], "FIGURE_NUMBERING": ["FigureNumbering", "FIG_NUMBERING", "CAPTION_NUMBERING", "FIGURE_STYLE"], "BACKMATTER_PAGES": ["Backmatter-Pages", "BACK_PAGES", "BACKMATTER_RANGE", "ENDMATTER_PAGES", "BackMatterPages"]}
    other = ["PAGES_DONE", "FIGURE_COUNT", "FIGURE_DPI", "PAGE_OFFSET", "FRONTMATTER_PAGES", "CH01_PAGES", "COPYRIGHT_PAGE"]
    for field, keys in known.items():
        for k in keys:
            r = S.revisions(conf(spark, ("b", 1, T0, {k: "1"}))).first()
            assert r[field] is not None and r[field].key == k, k
    r = S.revisions(conf(spark, ("b", 1, T0, {k: "1" for k in other}))).first()
    assert all(r[f] is None for f in S.FIELDS)


def test_changes(spark):
    got = S.changes(conf(
        spark,
        ("b", 1, T0, {"PAGE_COUNT": "10", "FIGURE_NUMBERING": "roman"}),
        ("b", 3, T0, {"N_PAGES": "10.0", "FIGURE_NUMBERING": '""'}),
        ("b", 4, T0, {"N_PAGES": ' "10.0" ', "BACK_PAGES": "3-4"}),
        ("b", 4, T1, {"N_PAGES": ' "10.0" ', "BACK_PAGES": "3-4"}),
        ("c", 9, T0, {"PAGE_COUNT": "1"}),
        ("d", 1, T0, None), ("d", 2, T0, {"PAGE_COUNT": "1"}), ("d", None, T0, {"PAGE_COUNT": "x"}),
        (None, 1, T0, {}), (None, 2, T0, {"PAGE_COUNT": "1"}),
    ))
    assert sorted((r.book or "", r.revision, r.field, r.change) for r in got.collect()) == [
        ("", 2, "PAGE_COUNT", "added"),
        ("b", 3, "FIGURE_NUMBERING", "removed"),
        ("b", 3, "PAGE_COUNT", "renamed"),
        ("b", 3, "PAGE_COUNT", "retyped"),
        ("b", 4, "BACKMATTER_PAGES", "added"),
        ("d", 2, "PAGE_COUNT", "added"),
    ]


def test_table_and_schema(spark):
    df = conf(spark, ("b", 1, T0, {"PAGE_COUNT": "12 pages", "FIGURE_STYLE": "2", "BACK_PAGES": "[7, 3]"}), ("b", 2, T0, {"PAGE_COUNT": "99999999999"}))
    rows = {r.revision: r for r in S.consistent_table(df).collect()}
    assert rows[1].page_count == 12 and rows[1].page_count_text == "12 pages" and rows[1].figure_numbering == "two-part"
    assert (rows[1].backmatter_first, rows[1].backmatter_last, rows[1].backmatter_pages_list) == (3, 7, "7,3")
    assert rows[2].page_count_type == "integer" and rows[2].page_count is None
    assert {(r.field, r.type, r.revisions) for r in S.fused_schema(df).collect()} == {("PAGE_COUNT", "text", 1), ("PAGE_COUNT", "integer", 1), ("FIGURE_NUMBERING", "integer", 1), ("BACKMATTER_PAGES", "list", 1)}


def test_empty(spark):
    df = spark.createDataFrame([], COLS)
    assert S.changes(df).count() == S.consistent_table(df).count() == S.fused_schema(df).count() == 0


def test_blocked_lag_is_lag(spark):
    import random

    random.seed(3)
    rows = sorted({(random.choice("ab"), random.randrange(0, 60)) for _ in range(70)})
    df = spark.createDataFrame(rows + [(None, 5), (None, 50)], "k string, o int")
    got = {(r.k, r.o): r.p for r in blocked_lag(df, ["k"], "o", F.col("o") * 10, "p", block=7).collect()}
    for k in ("a", "b", None):
        order = sorted(o for x, o in [*rows, (None, 5), (None, 50)] if x == k)
        assert [got[(k, o)] for o in order] == [None, *[o * 10 for o in order[:-1]]]


def test_latest_breaks_ties_and_takes_null_first(spark):
    df = spark.createDataFrame([(1, None, "z"), (1, T0, "a"), (1, T0, "b"), (2, None, "x")], "id int, t timestamp, v string")
    assert {r.id: r.v for r in latest(df, ["id"], "t").collect()} == {1: "b", 2: "x"}


def test_every_key_is_a_field(spark):
    rows = [("b", 1, 1, {"PAGE_COUNT": "7", "CH01_PAGES": "1-9", "Title": " "}), ("b", 2, 1, {"pageCount": "7.5", "ch01-pages": "[1, 9]", "": "x"}), ("b", 3, 1, None), (None, 1, 1, {"A_B": "true", "aB": "2"})]
    df = spark.createDataFrame(rows, "book string, revision int, loaded_at int, conf map<string,string>").selectExpr("*", "0 as field", "1 as committed_at")
    got = {tuple(r) for r in S.values(df).collect()}
    assert got == {("b", 1, "PAGE_COUNT", "PAGE_COUNT", "integer", "7"), ("b", 1, "CH01_PAGES", "CH01_PAGES", "range", "1-9"), ("b", 2, "PAGE_COUNT", "pageCount", "decimal", "7.5"), ("b", 2, "CH01_PAGES", "ch01-pages", "list", "[1, 9]"), (None, 1, "A_B", "A_B", "boolean", "true")}
    changes = {tuple(r) for r in S.all_changes(df).collect()}
    assert changes == {("b", 2, f, c) for f in ("PAGE_COUNT", "CH01_PAGES") for c in ("renamed", "retyped")} | {("b", 3, f, "removed") for f in ("PAGE_COUNT", "CH01_PAGES")}
    assert {(r.field, r.key) for r in S.fused_schema(df).collect()} >= {("CH01_PAGES", "ch01-pages"), ("A_B", "A_B")}
    assert S.values(df.limit(0)).count() == S.all_changes(df.limit(0)).count() == 0
