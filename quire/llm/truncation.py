"""Problem 6: text cut off by field limits or in transfer.

Two signs, both from statistics over all rows:

* limits: per table and source (origin, or model and input format) and unit (characters, bytes) a histogram of lengths;
  a limit is a spike at or near the source's greatest length (in its upper half), far above the mean count of the lengths
  in the half below it. Copies of one content count once, and a spike below the greatest length must hold ten contents,
  so that no chance meeting of lengths is one. A value at a limit was cut, and ``complete`` says whether it ends with
  terminal punctuation or a complete line all the same; for bytes a cut before a wide character may end up to three bytes
  below, there only without such an ending.
* endings: a value that does not end with a line end is cut unless its last line is complete for what the value is
  (TeX, Python, JSON, conf). Forms of last lines that have no terminal punctuation (lone commands, comments, statements)
  count as complete if they are the ending of at least a twentieth of the values that do end with a line end.

Everything is built from Spark's own expressions; histograms and endings are combined on the map side, so a source that
holds a third of the rows costs no more than another; the table of usual endings has at most twenty rows per kind.

Defined cases: repeated rows of an id count once (latest ``loaded_at``); null and empty contents, and trials that did not
succeed (any letter case), are no case but count as records of their source where content is not null; a null output
tail can only be a case by its length; null origin, model or format is a source of its own; a source needs at least
three values at its greatest length, or ten at a lower one, to have a limit there. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.cluster import cut, latest

SPIKE_ROWS, SPIKE_RATIO, USUAL, UNIFORM = 3, 10.0, 0.05, 0.8
SPIKE_BELOW = 10  # contents at a limit below the greatest length

#: Patterns of complete last lines. Fixed values of the languages.
SENTENCE = r"""[.!?…]["'’”)\]}]*\s*$"""
TEX_CLOSED = r"\\end\{[A-Za-z]+\*?\}\s*$|\\\]\s*$|^[^$]*(?:\$[^$]*\$[^$]*)*\}\s*$"
JSON_CLOSED = r"[,\[\]{}]\s*$"
CONF_CLOSED = r"""^\s*[A-Za-z_][A-Za-z0-9_]*=(?:"[^"]*"|'[^']*'|[^\s"']+)\s*$"""
PY_OPEN = r"[-+*/%=<>&|^~.,:(\[{\\]\s*$|^\s*#|^\s*(?:def|class|if|elif|while|for|with|import|from|return|raise|and|or|not|in|is)\s*$"


def _form(content: Column, suffix: Column) -> Column:
    """The language of the content itself: files may come under a wrong suffix."""
    return (
        F.when(content.rlike(r"\\(?:begin|end|section|chapter|input|item)\b"), "tex")
        .when((suffix == "json") & content.rlike(r"(?m)^[A-Z][A-Z0-9_]*="), "conf")
        .otherwise(F.coalesce(suffix, F.lit("tex")))
    )


def _records(files: DataFrame, results: DataFrame) -> DataFrame:
    """(tbl, rec_id, source, chars, bytes, last, ended, form): what is known of every value."""
    # measures of a text, not the text, are shuffled to keep the latest row
    f = files.select(
        F.lit("source_file").alias("tbl"),
        F.col("file_id").alias("rec_id"),
        "loaded_at",
        F.to_json(F.struct("origin")).alias("source"),
        F.length("content").cast("bigint").alias("chars"),
        F.octet_length("content").cast("bigint").alias("bytes"),
        F.xxhash64("content").alias("value"),
        F.substring_index(F.rtrim(F.col("content"), F.lit("\r\n")), "\n", -1).alias("last"),
        F.col("content").rlike(r"[\r\n]\z").alias("ended"),
        _form(F.col("content"), F.col("suffix")).alias("form"),
    )
    f = latest(f, ["tbl", "rec_id"], "loaded_at").drop("loaded_at").where("chars is not null")
    cols = ["result_id", "model", "input_format", "status", "output_length", "output_tail", "loaded_at"]
    r = latest(results.select(*cols), ["result_id"], "loaded_at").where(F.lower(F.trim("status")) == "success")
    r = r.select(
        F.lit("filter_test_result").alias("tbl"),
        F.col("result_id").alias("rec_id"),
        F.to_json(F.struct("model", "input_format")).alias("source"),
        F.col("output_length").cast("bigint").alias("chars"),
        F.lit(None).cast("bigint").alias("bytes"),
        F.xxhash64("result_id").alias("value"),  # what the output was is not known
        F.substring_index("output_tail", "\n", -1).alias("last"),
        F.lit(False).alias("ended"),
        F.lit("tex").alias("form"),
    )
    return f.unionByName(r)


def limits(records: DataFrame) -> DataFrame:
    """(tbl, source, unit, at): the lengths at which a source cuts, in the unit in which more values stand at them (cut at
    characters, a few values may also share the greatest number of bytes, and the other way round)."""
    units = F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("chars").alias("n")), F.struct(F.lit("bytes").alias("unit"), F.col("bytes").alias("n"))))
    one = records.select("tbl", "source", "value", units.alias("u")).where("u.n > 0").select("tbl", "source", "u.unit", "u.n", "value").distinct()
    hist = cut(one.groupBy("tbl", "source", "unit", "n").agg(F.count("*").alias("rows")))
    key = ["tbl", "source", "unit"]
    top = hist.groupBy(*key).agg(F.max("n").alias("most"))
    # lengths that could be limits are few: the greatest, and those of ten values or more in the upper half
    near = hist.join(top, key).where(((F.col("n") == F.col("most")) & (F.col("rows") >= SPIKE_ROWS)) | ((F.col("n") >= F.col("most") / 2) & (F.col("rows") >= SPIKE_BELOW)))
    sums = _below(hist, near.select(*key, F.col("n").alias("at"), F.col("rows").alias("rows_at")), key)
    usual = F.col("rows_below") / F.greatest(F.col("at") / 2, F.lit(1.0))
    top = sums.where(F.col("rows_at") >= SPIKE_RATIO * usual)
    unit = top.groupBy("tbl", "source", "unit").agg(F.sum("rows_at").alias("held")).groupBy("tbl", "source").agg(F.max(F.struct("held", "unit")).alias("b"))
    return top.join(unit.select("tbl", "source", F.col("b.unit").alias("unit")), key).select(*key, "at")


def _below(hist: DataFrame, near: DataFrame, key: list[str]) -> DataFrame:
    """``near`` with ``rows_below``: the values whose length is below ``at`` and at least half of it."""
    pairs = near.join(hist.select(*key, "n", "rows"), key).where("n < at and n >= at / 2")
    got = pairs.groupBy(*key, "at").agg(F.sum("rows").alias("rows_below"))
    return near.join(got, [*key, "at"], "left").fillna(0, ["rows_below"])


def _ending(last: Column, form: Column) -> Column:
    """The form of a last line without terminal punctuation: a comment by its first words, any other by its shape."""
    shape = F.regexp_replace(F.regexp_replace(last, r"[\p{L}]+", "w"), r"[0-9]+", "9")
    lone = F.regexp_extract(last, r"^\s*(\\[A-Za-z]+\*?)\s*$", 1)
    return (
        F.when((form == "tex") & last.rlike(r"^\s*%"), F.regexp_extract(last, r"^\s*(%\s*\S+)", 1))
        .when((form == "tex") & (lone != ""), lone)
        .when((form == "py") & ~last.rlike(r"^\s*#"), shape)
    )


def judged(files: DataFrame, results: DataFrame) -> DataFrame:
    """Every record of the two tables with its cut: ``limit``, ``ending`` or null for a whole value; of a limit the unit and
    length, and whether the value ends completely all the same."""
    # measures only, read by the histograms, by the count of endings and by the judgement
    rec = cut(_records(files, results).withColumn("ending", _ending(F.col("last"), F.col("form"))))
    lim = cut(limits(rec))
    char_limit = lim.where("unit = 'chars'").select("tbl", "source", F.col("at").alias("chars"), F.lit(True).alias("at_chars"))
    byte_limit = lim.where("unit = 'bytes'").select("tbl", "source", "at", F.explode(F.array(*[F.col("at") - k for k in range(4)])).alias("bytes"))
    byte_limit = byte_limit.groupBy("tbl", "source", "bytes").agg(F.min("at").alias("byte_limit"))
    # outputs are kept without their line end, so all their endings are looked at
    seen = rec.where("ended or tbl = 'filter_test_result'").where("ending is not null").groupBy("tbl", "form", "ending").agg(F.count("*").alias("n"))
    seen = seen.withColumn("comment", F.col("ending").startswith("%"))
    part = F.col("n") / F.col("total")
    total = seen.groupBy("tbl", "form", "comment").agg(F.sum("n").alias("total"))
    usual = seen.join(total, ["tbl", "form", "comment"]).withColumn("part", part).where(F.col("part") >= USUAL)  # at most twenty rows a kind
    kinds = usual.groupBy("tbl", "form").agg((F.sum("part") >= UNIFORM).alias("uniform"))
    usual = usual.select("tbl", "form", "ending", F.lit(True).alias("usual"))
    rec = rec.join(char_limit, ["tbl", "source", "chars"], "left").join(byte_limit, ["tbl", "source", "bytes"], "left")
    rec = rec.join(usual, ["tbl", "form", "ending"], "left").join(kinds, ["tbl", "form"], "left")
    last, form = F.col("last"), F.col("form")
    usual_, uniform_ = F.coalesce("usual", F.lit(False)), F.coalesce("uniform", F.lit(False))
    closed_py = ~last.rlike(PY_OPEN) & (F.length(F.regexp_replace(last, r"[^\"']", "")) % 2 == 0) & (F.length(F.regexp_replace(last, r"[^(\[{]", "")) == F.length(F.regexp_replace(last, r"[^)\]}]", "")))
    whole = (
        F.when(last.isNull() | F.col("ended") | (F.trim(last) == ""), True)
        .when((form == "tex") & last.rlike(r"^\s*%"), usual_)
        .when(form == "tex", last.rlike(SENTENCE) | last.rlike(TEX_CLOSED) | usual_)
        .when(form == "json", last.rlike(JSON_CLOSED))
        .when(form == "conf", last.rlike(CONF_CLOSED))
        .when(form == "py", F.when(uniform_, usual_ | last.rlike(r"^\s*\"\"\"\s*$|\"\"\"\s*$") & ~last.rlike(r'^\s*"""[^"]+$')).otherwise(closed_py))
        .otherwise(last.rlike(SENTENCE))
    )
    near = F.col("byte_limit").isNotNull() & ((F.col("bytes") == F.col("byte_limit")) | ~whole)
    at_limit = F.coalesce("at_chars", F.lit(False)) | F.coalesce(near, F.lit(False))
    sign = F.when(F.col("chars") == 0, None).when(at_limit, "limit").when(~whole, "ending")
    unit = F.when(sign == "limit", F.when(F.coalesce("at_chars", F.lit(False)), "chars").otherwise("bytes"))
    at = F.when(unit == "chars", F.col("chars")).when(unit == "bytes", F.col("byte_limit"))
    complete = F.coalesce(last.rlike(SENTENCE), F.lit(False)) | (whole & last.isNotNull())
    return rec.select("tbl", "rec_id", "source", "chars", "bytes", sign.alias("cut"), unit.alias("unit"), at.alias("at"), F.when(sign == "limit", complete).alias("complete"))


def found(files: DataFrame, results: DataFrame) -> DataFrame:
    """(tbl, rec_id) of the cut records."""
    return cases(files, results).select("tbl", "rec_id")


def cases(files: DataFrame, results: DataFrame) -> DataFrame:
    """(tbl, rec_id, sign, unit, at, complete) of the cut records: which sign found each, and for a limit where it is and
    whether the value ends completely all the same."""
    rows = judged(files, results).where("cut is not null and rec_id is not null")
    return rows.select("tbl", "rec_id", F.col("cut").alias("sign"), "unit", "at", "complete")


def source_rates(files: DataFrame, results: DataFrame) -> DataFrame:
    """How often each source cuts: (tbl, source, records, at_limit, complete_at_limit, by_ending, rate, char_limit,
    byte_limit), the limits being the greatest at which a value stands."""
    out = judged(files, results).groupBy("tbl", "source").agg(
        F.count("*").alias("records"),
        F.count_if(F.col("cut") == "limit").alias("at_limit"),
        F.count_if("complete").alias("complete_at_limit"),
        F.count_if(F.col("cut") == "ending").alias("by_ending"),
        F.max(F.when(F.col("unit") == "chars", F.col("at"))).alias("char_limit"),
        F.max(F.when(F.col("unit") == "bytes", F.col("at"))).alias("byte_limit"),
    )
    return out.withColumn("rate", F.round((F.col("at_limit") + F.col("by_ending")) / F.col("records"), 6))
