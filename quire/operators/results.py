"""Analytics of experiment results. Status is compared without letter case; repeated rows of an id count once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.cluster import latest


def error_class(error: Column) -> Column:
    """blocked, retry or error of an error message; null for none."""
    e = F.lower(error)
    return (
        F.when(error.isNull() | (error == ""), None)
        .when(e.contains("content filtering policy") | e.contains("output blocked"), "blocked")
        .when(error.contains("429") | error.contains("rate_limit") | error.contains("529") | error.contains("overloaded"), "retry")
        .otherwise("error")
    )


def holds_metadata(test_name: Column) -> Column:
    """Whether a variant is recorded as holding metadata: by its name alone."""
    return F.coalesce(test_name.contains("metadata") | test_name.contains("title"), F.lit(False))


def summary(results: DataFrame, groups: list[str]) -> DataFrame:
    """Totals per group and prefix of groups: tests, success, blocked, other, characters, mean latency."""
    r = latest(results.select("result_id", *groups, "status", "output_length", "latency_ms", "loaded_at"), ["result_id"], "loaded_at")
    s = F.lower(F.trim("status"))
    level = sum((1 - F.grouping(g) for g in groups), F.lit(0))
    return r.rollup(*groups).agg(
        F.count("*").alias("tests"),
        F.count_if(s == "success").alias("success"),
        F.count_if(s == "blocked").alias("blocked"),
        (F.count("*") - F.count_if(s == "success") - F.count_if(s == "blocked")).alias("other"),
        F.sum(F.coalesce("output_length", F.lit(0)).cast("bigint")).alias("output_chars"),
        F.round(F.avg("latency_ms"), 3).alias("mean_latency_ms"),
        level.cast("int").alias("level"),
    )


def appended(history: DataFrame, new: DataFrame) -> DataFrame:
    """New results after the history, columns matched by name."""
    return history.unionByName(new, allowMissingColumns=True)


def selected(results: DataFrame, suite: str | None = None) -> DataFrame:
    """The results of one suite, or of all."""
    return results if suite is None else results.where(F.col("suite") == suite)


def first_present(candidates: DataFrame, keys: list[str], preference: list[str], path: str = "rel_path") -> DataFrame:
    """For each key the most preferred path that is present."""
    rank = F.array_position(F.array(*map(F.lit, preference)), F.col(path))
    return candidates.where(rank > 0).groupBy(*keys).agg(F.min_by(path, rank).alias(path))
