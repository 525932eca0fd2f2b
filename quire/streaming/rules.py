"""The same operators on files as they arrive: a file stream in, rewritten files and violations out.

Rewrites and marker scans keep no state, so the batch expressions run unchanged. Re-delivered files are dropped within a
watermark by (path, modification time); counts per book are windowed by arrival.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.functions.text import utf8_text
from quire.operators.checks import forbidden_markers
from quire.operators.rewrite import rewritten
from quire.sources.readers import located


def arriving(spark: SparkSession, root: str, pattern: str = "*.tex", per_trigger: int = 10_000) -> DataFrame:
    """Stream of (path, arrived, book, rel_path, chapter, stem, suffix, ordinal, content)."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    raw = (
        spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", per_trigger).load(root)
    )
    out = located(raw.select("path", F.col("modificationTime").alias("arrived"), utf8_text(F.col("content")).alias("content")), F.col("path"), root)
    return out.withWatermark("arrived", "1 hour").dropDuplicatesWithinWatermark(["path", "arrived"])


def repaired(stream: DataFrame) -> DataFrame:
    return rewritten(stream, "content")


def marked(stream: DataFrame) -> DataFrame:
    return forbidden_markers(stream, ["path", "book", "arrived"], "content")


def fixes_per_book(stream: DataFrame, window: str = "10 minutes") -> DataFrame:
    """Repairs per book and window of arrival."""
    r = repaired(stream)
    return r.groupBy(F.window("arrived", window), "book").agg(F.count("*").alias("files"), F.sum("total_fixes").alias("fixes"))


def run_available(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet"):
    """Process what is there and stop; call again for what arrives later."""
    return df.writeStream.format(fmt).option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
