"""Repair until nothing changes: rewrite, look at the errors, rewrite again, a bounded number of times.

The loop is the driver's; each round is one distributed job over all files and only its counters come back. Rounds are cut
by checkpoints in the shared folder, so a lost executor repeats no round and plans stay short.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.cluster import cut
from quire.operators.rewrite import rewritten

MAX_ROUNDS = 10


@dataclass(frozen=True)
class Outcome:
    """``files`` after the last round; ``reason`` is clean, stable or limit."""

    files: DataFrame
    rounds: int
    fixes: int
    reason: str


def until_stable(files: DataFrame, errors: Callable[[DataFrame], DataFrame] | None = None, text: str = "content", max_rounds: int = MAX_ROUNDS) -> Outcome:
    """Rewrite ``files`` until ``errors(files)`` is empty, a round fixes nothing, or ``max_rounds`` are done. Without an
    error source only the fixes decide."""
    fixes, columns = 0, files.columns
    for n in range(max_rounds):
        if errors is not None and errors(files).isEmpty():
            return Outcome(files, n, fixes, "clean")
        done = cut(rewritten(files, text))
        now = done.agg(F.sum("total_fixes")).first()[0] or 0
        files, fixes = done.select(*columns), fixes + now
        if not now:
            return Outcome(files, n + 1, fixes, "stable")
    return Outcome(files, max_rounds, fixes, "limit")
