"""Queries of the operators for training data, over whole tables with production parameters, and SQL for those that
SQL can express in reasonable time."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.cluster import read
from quire.llm import lookalike, mixing, ocr, parsing, spans, splitting, tokens, truncation


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return splitting.page_pieces(read(spark, d, "chapter_range"), read(spark, d, "toc_section"))


def p2_text_pieces(spark: SparkSession, d: str) -> DataFrame:
    return splitting.text_pieces(read(spark, d, "documents"))


def _repair(spark: SparkSession, d: str) -> ocr.Repair:
    return ocr.Repair(read(spark, d, "ocr_page"), read(spark, d, "toc_section"), read(spark, d, "chapter_range"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _repair(spark, d).found()


def p3_text(spark: SparkSession, d: str) -> DataFrame:
    return _repair(spark, d).texts()


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = spans.Shared(read(spark, d, "source_file")).pairs()
    return pairs.withColumnsRenamed({"a": "file_id_a", "b": "file_id_b"})


def p4_portions(spark: SparkSession, d: str) -> DataFrame:
    return spans.Shared(read(spark, d, "source_file")).portions()


def p4_groups(spark: SparkSession, d: str) -> DataFrame:
    return spans.Shared(read(spark, d, "source_file")).members()


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return parsing.found(read(spark, d, "source_file"))


def p5_files(spark: SparkSession, d: str) -> DataFrame:
    return parsing.parsed(read(spark, d, "source_file"))


def p5_rates(spark: SparkSession, d: str) -> DataFrame:
    return parsing.rates(read(spark, d, "source_file"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.found(read(spark, d, "source_file"), read(spark, d, "filter_test_result"))


def p6_cases(spark: SparkSession, d: str) -> DataFrame:
    return truncation.cases(read(spark, d, "source_file"), read(spark, d, "filter_test_result"))


def p6_rates(spark: SparkSession, d: str) -> DataFrame:
    return truncation.source_rates(read(spark, d, "source_file"), read(spark, d, "filter_test_result"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.token_ids(read(spark, d, "documents"))


def p7_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Ids decoded again: the texts by their hash and length, null texts as empty ones."""
    out = tokens.decoded(tokens.token_ids(read(spark, d, "documents")))
    return out.select("doc_id", F.md5("text").alias("text_md5"), F.length("text").cast("bigint").alias("chars"))


def _mix(spark: SparkSession, d: str, size: int | str | None = None) -> tuple[DataFrame, DataFrame]:
    sizes = mixing.counted(read(spark, d, "documents"))
    return sizes, mixing.rates(sizes, read(spark, d, "mix_target"), size)


def p8_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.chosen(*_mix(spark, d))


def p8_shares(spark: SparkSession, d: str) -> DataFrame:
    sizes, rate = _mix(spark, d)
    return mixing.shares(mixing.chosen(sizes, rate), rate)


def p8_exact_mix(spark: SparkSession, d: str) -> DataFrame:
    """The largest mixes in which every share is met."""
    return mixing.chosen(*_mix(spark, d, mixing.EXACT))


def p8_exact_shares(spark: SparkSession, d: str) -> DataFrame:
    sizes, rate = _mix(spark, d, mixing.EXACT)
    return mixing.shares(mixing.chosen(sizes, rate), rate)


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = lookalike.same_looking(read(spark, d, "documents"))
    return pairs.withColumnsRenamed({"a": "doc_id_a", "b": "doc_id_b"})


def p9_text(spark: SparkSession, d: str) -> DataFrame:
    return lookalike.consistent(read(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p2_found, p2_text_pieces, p3_found, p3_text, p4_found, p4_portions, p4_groups, p5_found, p5_files, p5_rates, p6_found, p6_cases, p6_rates, p7_ids, p7_round_trip, p8_mix, p8_shares, p8_exact_mix, p8_exact_shares, p9_found, p9_text)}


P2_FOUND = """
WITH RECURSIVE latest AS (
    SELECT book, chapter, start_page, end_page FROM chapter_range
    WHERE book IS NOT NULL AND chapter IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY book, chapter ORDER BY loaded_at DESC NULLS LAST, end_page DESC NULLS LAST,
                               start_page DESC NULLS LAST, title DESC NULLS LAST) = 1
), long AS (SELECT * FROM latest WHERE end_page - start_page >= 6),
marks AS (SELECT DISTINCT book, chapter, page_no - 1 AS p FROM toc_section WHERE page_no IS NOT NULL),
starts AS (
    SELECT l.book, l.chapter, l.end_page, g.s FROM long l CROSS JOIN LATERAL (SELECT unnest(range(l.start_page, l.end_page + 1)) AS s) g
), ends AS (
    SELECT t.book, t.chapter, t.s, CASE WHEN any_value(t.end_page) - t.s + 1 <= 6 THEN any_value(t.end_page) ELSE coalesce(max(m.p), t.s + 5) END AS e
    FROM starts t LEFT JOIN marks m ON m.book = t.book AND m.chapter = t.chapter AND m.p BETWEEN t.s + 1 AND t.s + 5
    GROUP BY t.book, t.chapter, t.s
), walk AS (
    SELECT l.book, l.chapter, l.end_page, l.start_page AS s, e.e FROM long l JOIN ends e ON e.book = l.book AND e.chapter = l.chapter AND e.s = l.start_page
    UNION ALL
    SELECT w.book, w.chapter, w.end_page, w.e, e.e FROM walk w JOIN ends e ON e.book = w.book AND e.chapter = w.chapter AND e.s = w.e
    WHERE w.e < w.end_page
)
SELECT book, chapter, CAST(s AS INTEGER) AS piece_start, CAST(e AS INTEGER) AS piece_end FROM walk
"""


P7_ROUND_TRIP = "SELECT doc_id, md5(coalesce(text, '')) AS text_md5, length(coalesce(text, '')) AS chars FROM documents"


_WINDOWS = """WITH f AS (SELECT file_id, content FROM source_file QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY loaded_at DESC NULLS LAST) = 1),
    c AS (SELECT DISTINCT content FROM f WHERE length(content) >= 200),
    w AS (SELECT content, i, substr(content, i, 200) AS g FROM (SELECT content, unnest(range(1, length(content) - 198)) AS i FROM c))"""
#: Every window of 200 characters against every other, by equality.
P4_FOUND = _WINDOWS + """, d AS (SELECT DISTINCT content, g FROM w), two AS (SELECT g FROM d GROUP BY g HAVING count(*) > 1),
    held AS (SELECT d.content, d.g FROM d JOIN two USING (g)),
    pair AS (SELECT DISTINCT a.content AS ca, b.content AS cb FROM held a JOIN held b ON a.g = b.g AND a.content <> b.content UNION ALL SELECT content, content FROM c)
    SELECT DISTINCT x.file_id AS file_id_a, y.file_id AS file_id_b FROM pair JOIN f x ON x.content = ca JOIN f y ON y.content = cb WHERE x.file_id < y.file_id"""
P4_PORTIONS = _WINDOWS + """, d AS (SELECT DISTINCT content, g FROM w), two AS (SELECT g FROM d GROUP BY g HAVING count(*) > 1),
    s AS (SELECT content, i, lead(i) OVER (PARTITION BY content ORDER BY i) AS j FROM w JOIN two USING (g)),
    part AS (SELECT content, sum(least(200, coalesce(j - i, 200))) AS part FROM s GROUP BY content),
    n AS (SELECT coalesce(content, '') AS content, count(*) AS copies FROM f GROUP BY 1),
    r AS (SELECT f.file_id, length(coalesce(f.content, '')) AS n_chars, n.copies, CAST(CASE WHEN n.copies > 1 AND length(f.content) >= 200 THEN length(f.content) ELSE coalesce(p.part, 0) END AS BIGINT) AS shared_chars
          FROM f JOIN n ON n.content = coalesce(f.content, '') LEFT JOIN part p ON p.content = f.content)
    SELECT file_id, CAST(n_chars AS INTEGER) AS n_chars, copies, shared_chars, CASE WHEN n_chars > 0 THEN round(shared_chars / n_chars, 6) ELSE 0.0 END AS share FROM r"""


def _folded() -> str:
    """SQL that folds every character on its own: what each looks like, composed, from the operator's fixed tables."""
    rows = []
    for cp in (*range(0x80, 0xD800), *range(0xF900, 0x10000), *range(0x1D400, 0x1D800)):
        if 0x3400 <= cp < 0xA000 or 0xAC00 <= cp < 0xD7A4:  # ideographs and syllables are themselves
            continue
        to = unicodedata.normalize("NFD", lookalike.classes(chr(cp)))
        if to != unicodedata.normalize("NFD", chr(cp)) or unicodedata.combining(chr(cp)) == 0 and len(to) > 1:
            rows.append((cp, to))
    values = ", ".join("(%d, %s)" % (cp, "'" + to.replace("'", "''").replace("\n", "' || chr(10) || '") + "'") for cp, to in rows)
    return f"""WITH looks(cp, looks) AS (VALUES {values}),
    chars AS (SELECT doc_id, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS i FROM documents WHERE text <> ''),
    folded AS (SELECT doc_id, nfc_normalize(string_agg(coalesce(looks, replace(ch, chr(9), ' ')), '' ORDER BY i)) AS form FROM chars LEFT JOIN looks ON cp = unicode(ch) GROUP BY doc_id),
    t AS (SELECT DISTINCT doc_id, form, text FROM folded JOIN documents USING (doc_id) WHERE trim(form, ' ' || chr(10)) <> '')
    SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM t a JOIN t b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": P2_FOUND, "p4_found": P4_FOUND, "p4_portions": P4_PORTIONS, "p7_round_trip": P7_ROUND_TRIP, "p9_found": _folded()}
