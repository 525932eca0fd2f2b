"""Progress files: check lists and tables, and how far each phase is. Null texts hold no item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import lines, stripped

ITEM = r"^\s*[-*] \[([ xX])\]\s*(.*?)\s*$"
HEAD = r"^#{1,6}\s+(.*?)\s*$"


def items(text: Column) -> Column:
    """Array of (line_no, section, item, done): check-list lines, each under the nearest heading above it."""
    start = F.struct(F.lit(None).cast("string").alias("section"), F.array().cast("array<struct<line_no:int,section:string,item:string,done:boolean>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        head, line = F.regexp_extract(x["line"], HEAD, 1), x["line"]
        section = F.when(line.rlike(HEAD), head).otherwise(s["section"])
        found = F.struct(x["n"].alias("line_no"), section.alias("section"), F.regexp_extract(line, ITEM, 2).alias("item"), (F.lower(F.regexp_extract(line, ITEM, 1)) == "x").alias("done"))
        return F.struct(section.alias("section"), F.when(line.rlike(ITEM), F.concat(s["out"], F.array(found))).otherwise(s["out"]).alias("out"))

    rows = F.transform(lines(text), lambda x, i: F.struct((i + 1).alias("n"), x.alias("line")))
    return F.aggregate(rows, start, step, lambda s: s["out"])


def check_list(files: DataFrame, keys: list[str], text: str) -> DataFrame:
    return files.select(*keys, F.explode(items(F.col(text))).alias("i")).select(*keys, "i.*")


def table_rows(files: DataFrame, keys: list[str], text: str) -> DataFrame:
    """(keys, line_no, cells) of the rows of ``|`` tables, without separator lines."""
    rows = files.select(*keys, F.posexplode(lines(F.col(text))).alias("line_no", "line")).where(F.col("line").rlike(r"^\s*\|.*\|\s*$") & ~F.col("line").rlike(r"^[\s|:-]+$"))
    inner = F.regexp_replace(F.regexp_replace("line", r"^\s*\|", ""), r"\|\s*$", "")
    return rows.select(*keys, (F.col("line_no") + 1).alias("line_no"), F.transform(F.split(inner, r"\|", -1), stripped).alias("cells"))


def roll_up(done: DataFrame, groups: list[str], flag: str = "done") -> DataFrame:
    """Items, done items and share per group, prefix of groups and in total."""
    level = sum((1 - F.grouping(g) for g in groups), F.lit(0))
    out = done.rollup(*groups).agg(F.count("*").alias("items"), F.count_if(F.col(flag)).alias("done"), level.cast("int").alias("level"))
    return out.withColumn("share", F.when(F.col("items") > 0, F.round(F.col("done") / F.col("items"), 6)))
