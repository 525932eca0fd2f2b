"""Problem 5: source files that do not parse, by packrat parsing of each file's language.

Each distinct file is parsed whole by the grammar of its suffix (see ``peg``); a file is valid only if the grammar
consumes all of it. Invalid files keep the furthest failure, what was expected there and a cause.

Defined cases: repeated rows of a file_id count once (latest ``loaded_at``); null or empty content is neither valid nor
invalid and counts only in ``files``; a suffix without a grammar (or null) is not checked; null book is a group of its
own. Nesting of any depth is parsed. Empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.cluster import latest, spread

SCHEMA = "file_id bigint, book string, suffix string, loaded_at timestamp, checked boolean, valid boolean, fail_offset int, fail_line int, expected string, cause string"


def parsed(files: DataFrame) -> DataFrame:
    """One row per file: validity, furthest failure, cause (truncated, conflict, wrong language, syntax). Rows are parsed
    where they are read; what is shuffled to keep the latest row of a file is its result, not its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quire.llm.peg import check

        for batch in batches:
            cols: list[list] = [[] for _ in range(6)]
            for suffix, text in zip(batch.column(2).to_pylist(), batch.column(4).to_pylist()):
                got = check(suffix, text) if text else None
                if got is None:
                    row = (False, None, None, None, None, None)
                else:
                    ok, far, want, conflict = got
                    cause = None
                    if not ok:
                        rest = text[far:].strip()
                        cause = "conflict" if conflict else "wrong language" if want.startswith("LaTeX, not") or far == 0 else "truncated" if not rest else "syntax"
                    row = (True, ok, None if ok else far, None if ok else text.count("\n", 0, far) + 1, want or None, cause)
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = (pa.bool_(), pa.bool_(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], *[pa.array(c, k) for c, k in zip(cols, kinds)]], [x.split(" ")[0] for x in SCHEMA.split(", ")])

    rows = spread(files.select("file_id", "book", "suffix", F.col("loaded_at").cast("timestamp").alias("loaded_at"), "content")).mapInArrow(run, SCHEMA)
    return latest(rows, ["file_id"], "loaded_at").drop("loaded_at")


def found(files: DataFrame) -> DataFrame:
    return parsed(files).where("checked and not valid").select("file_id")


def rates(files: DataFrame) -> DataFrame:
    """(book, suffix, files, checked, invalid, conflicts, truncated, rate) per repository and language, with a total per
    suffix (book null and ``all_books`` true). Totals are summed from the groups: one hot book costs no more."""
    per = parsed(files).groupBy("book", "suffix").agg(
        F.count("*").alias("files"),
        F.count_if("checked").alias("checked"),
        F.count_if(F.expr("checked and not valid")).alias("invalid"),
        F.count_if(F.col("cause") == "conflict").alias("conflicts"),
        F.count_if(F.col("cause") == "truncated").alias("truncated"),
    )
    sums = [F.sum(c).alias(c) for c in ("files", "checked", "invalid", "conflicts", "truncated")]
    out = per.groupingSets([["book", "suffix"], ["suffix"]], "book", "suffix").agg(*sums, (F.grouping("book") == 1).alias("all_books"))
    return out.withColumn("rate", F.when(F.col("checked") > 0, F.round(F.col("invalid") / F.col("checked"), 6)))
