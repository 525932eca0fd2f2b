"""Errors in typesetting logs: unwrapping, parsing, locating and de-duplicating, as ordered windows.

Input rows are (log_id, line_no, line); a log's lines are ordered by ``line_no``. All windows are partitioned by log.
Null lines are empty lines. Two records of one log are the same if file, line and message are equal, nulls included.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.text import int_of

#: Suffixes of files named in errors; shortest and least frequent line length of a wrapped log. Fixed values.
SOURCE = r"(?:tex|sty|cls|clo|def|cfg|ltx|fd|aux|bbl|bst|toc|out)"
FILE_LINE = r"^((?:[A-Za-z]:)?[^:\r\n]+?\." + SOURCE + r"):(\d+):\s*(\S.*?)\s*$"
BANG = r"^!\s*(\S.*?)\s*$"
OPEN_FILE = r"\(((?:[A-Za-z]:)?[^()\s]*?\." + SOURCE + r")\b"
ECHO = r"^l\.(\d+)[\s.]"
MIN_WIDTH, MIN_REPEATS, LOOKAHEAD, CONTEXT_LINES, CONTEXT_CHARS = 60, 5, 10, 6, 200


def wrap_widths(lines: DataFrame) -> DataFrame:
    """(log_id, width) of the logs that are hard-wrapped: the most frequent length of at least 60 (ties: the smallest)
    that repeats 5 times or more, with almost no longer line. From a histogram of lengths, not from the lines."""
    hist = lines.groupBy("log_id", F.length(F.coalesce("line", F.lit(""))).alias("len")).agg(F.count("*").alias("c"))
    w = Window.partitionBy("log_id")
    hist = hist.withColumn("total", F.sum("c").over(w))
    top = F.max(F.when(F.col("len") >= MIN_WIDTH, F.struct("c", (-F.col("len")).alias("m")))).over(w)
    hist = hist.withColumn("width", -top["m"]).withColumn("repeats", top["c"])
    longer = F.sum(F.when(F.col("len") > F.col("width"), F.col("c")).otherwise(0))
    out = hist.groupBy("log_id").agg(F.first("width").alias("width"), F.first("repeats").alias("repeats"), F.first("total").alias("total"), longer.alias("longer"))
    ok = (F.col("repeats") >= MIN_REPEATS) & (F.col("longer") <= F.greatest(F.lit(3), F.floor(F.col("total") / 50)))
    return out.where(ok).select("log_id", "width")


def starts_record(line: Column) -> Column:
    return line.rlike(FILE_LINE) | line.rlike(BANG)


def unwrapped(lines: DataFrame) -> DataFrame:
    """(log_id, line_no, line) with wrapped lines joined; ``line_no`` is that of a joined line's first part.

    A line joins the one before if that is, as joined so far, exactly as long as the width and the line starts no record.
    This depends on all joins before, so wrapped logs are folded one log at a time; logs that are not wrapped, and all
    other work, stay in the JVM."""
    rows = lines.select("log_id", F.col("line_no").cast("bigint").alias("line_no"), F.coalesce("line", F.lit("")).alias("line"))
    rows = rows.join(wrap_widths(lines), "log_id", "left").withColumn("starts", starts_record(F.col("line")))
    schema = rows.select("log_id", "line_no", "line").schema

    def fold(log: pd.DataFrame) -> pd.DataFrame:
        log = log.sort_values("line_no", kind="stable")
        width, out = int(log["width"].iloc[0]), []
        for no, line, starts in zip(log["line_no"], log["line"], log["starts"]):
            if out and len(out[-1][1]) == width and not starts:
                out[-1][1] += line
            else:
                out.append([no, line])
        return pd.DataFrame({"log_id": log["log_id"].iloc[0], "line_no": [x for x, _ in out], "line": [x for _, x in out]})

    whole = rows.where("width is null").select("log_id", "line_no", "line")
    return whole.unionByName(rows.where("width is not null").groupBy("log_id").applyInPandas(fold, schema))


def unwrapped_texts(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, line_no, line) as ``unwrapped`` has them, of logs that are one text each: width and joins are found where the
    text is read, so no line is shuffled. Null texts have no lines."""
    kind = texts.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record = re.compile(f"{FILE_LINE}|{BANG}")
        for batch in batches:
            keys, numbers, out = [], [], []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t is None:
                    continue
                width, parts, size = width_of(lines_ := t.split("\n")), [], -1
                for no, line in enumerate(lines_):
                    if parts and size == width and not record.search(line):
                        parts[-1].append(line)
                        size += len(line)
                    else:
                        parts.append([line])
                        numbers.append(no)
                        size = len(line)
                keys += [k] * len(parts)
                out += ["".join(p) for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array(keys, batch.column(0).type), pa.array(numbers, pa.int64()), pa.array(out, pa.string())], [key, "line_no", "line"])

    return texts.select(key, text).mapInArrow(run, f"`{key}` {kind}, line_no bigint, line string")


def width_of(lines_: list[str]) -> int | None:
    """The width of one hard-wrapped log, by the rule of ``wrap_widths``; None if it is not wrapped."""
    hist = Counter(map(len, lines_))
    best = max(((c, -n) for n, c in hist.items() if n >= MIN_WIDTH), default=None)
    if best is None or best[0] < MIN_REPEATS:
        return None
    longer = sum(c for n, c in hist.items() if n > -best[1])
    return -best[1] if longer <= max(3, len(lines_) // 50) else None


def relative_path(path: Column, root: str | None = None) -> Column:
    """Forward slashes; below ``root`` relative to it."""
    p = F.replace(path, F.lit("\\"), F.lit("/"))
    if root is None:
        return p
    base = root.rstrip("/") + "/"
    return F.when(p.startswith(base), F.substring(p, len(base) + 1, 1_000_000)).otherwise(p)


def errors(lines: DataFrame, root: str | None = None) -> DataFrame:
    """(log_id, line_no, message, file, line, context) of every distinct error, first occurrence.

    ``file:line: message`` records name their place. ``! message`` records take the first ``l.N`` echo of the next ten
    lines and the last file opened on the nearest line before that opens one."""
    w = Window.partitionBy("log_id").orderBy("line_no")
    text = F.coalesce("line", F.lit(""))
    rows = lines.select("log_id", "line_no", text.alias("text"))
    rows = rows.withColumn("opens", F.try_element_at(F.regexp_extract_all("text", F.lit(OPEN_FILE), F.lit(1)), F.lit(-1)))
    rows = rows.withColumn("echo", int_of(F.col("text"), ECHO))
    rows = rows.withColumn("near_file", F.last("opens", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("near_line", F.first("echo", ignorenulls=True).over(w.rowsBetween(1, LOOKAHEAD)))
    rows = rows.withColumn("context", F.substring(F.array_join(F.collect_list("text").over(w.rowsBetween(0, CONTEXT_LINES - 1)), "\n"), 1, CONTEXT_CHARS))
    placed = F.col("text").rlike(FILE_LINE)
    rows = rows.where(placed | F.col("text").rlike(BANG)).select(
        "log_id",
        "line_no",
        F.when(placed, F.regexp_extract("text", FILE_LINE, 3)).otherwise(F.regexp_extract("text", BANG, 1)).alias("message"),
        relative_path(F.when(placed, F.regexp_extract("text", FILE_LINE, 1)).otherwise(F.col("near_file")), root).alias("file"),
        F.when(placed, int_of(F.col("text"), FILE_LINE, 2)).otherwise(F.col("near_line")).alias("line"),
        "context",
    )
    first = F.row_number().over(Window.partitionBy("log_id", "file", "line", "message").orderBy("line_no"))
    return rows.withColumn("__n", first).where("__n = 1").drop("__n")


def errors_of_all(runs: DataFrame, lines: DataFrame, root: str | None = None) -> DataFrame:
    """Errors of every run in ``runs`` (log_id); a run that left no log at all has one error that says so."""
    found = errors(lines, root)
    none = runs.select("log_id").distinct().join(lines.select("log_id").distinct(), "log_id", "left_anti")
    kinds = dict(found.dtypes)
    gone = none.select("log_id", *[(F.lit("no log was written") if c == "message" else F.lit(None)).cast(kinds[c]).alias(c) for c in found.columns if c != "log_id"])
    return found.unionByName(gone)


def error_files(found: DataFrame) -> DataFrame:
    """(file, errors): the distinct files named in errors."""
    return found.where("file is not null").groupBy("file").agg(F.count("*").alias("errors"))


def top_files(files: DataFrame, n: int) -> DataFrame:
    """The n files with most errors; ties: the first by name."""
    return files.orderBy(F.desc("errors"), "file").limit(n)


def files_beyond(files: DataFrame, n: int) -> DataFrame:
    """(files, errors): one row, how many files are beyond the n with most errors, and the errors in them."""
    rest = files.join(top_files(files, n).select("file"), "file", "left_anti")
    return rest.agg(F.count("*").alias("files"), F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"))
