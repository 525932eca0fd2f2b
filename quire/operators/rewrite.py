"""Deterministic rewrite rules over texts, each with a counter, applied in order.

A rule is a pair of column builders: the rewritten text and the number of rewrites, counted on the text as the rules
before it left it. ``rewritten`` stacks one projection per rule, so no expression is evaluated twice.

Nulls: a null text stays null and counts 0.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import WORD, count_of, is_math_line, lines


@dataclass(frozen=True)
class Rule:
    """``apply(text)`` is the rewritten text, ``count(text)`` how often the rule fires on it."""

    name: str
    apply: Callable[[Column], Column]
    count: Callable[[Column], Column]


def guarded(rule: Rule, may_fire: Callable[[Column], Column]) -> Rule:
    """The rule behind a cheap test: texts it cannot touch cost a literal search and no regular expression."""
    return Rule(
        rule.name,
        lambda c: F.when(may_fire(c), rule.apply(c)).otherwise(c),
        lambda c: F.when(may_fire(c), rule.count(c)).otherwise(F.lit(0).cast("bigint")),
    )


def holds(*literals: str) -> Callable[[Column], Column]:
    """Whether a text holds one of the literals."""

    def test(c: Column) -> Column:
        out = c.contains(literals[0])
        for x in literals[1:]:
            out = out | c.contains(x)
        return out

    return test


def pattern_rule(name: str, *steps: tuple[str, str]) -> Rule:
    """A rule of regular replacements in sequence; counts are those of the texts in between."""

    def apply(c: Column) -> Column:
        for pattern, into in steps:
            c = F.regexp_replace(c, pattern, into)
        return c

    def count(c: Column) -> Column:
        total = F.lit(0).cast("bigint")
        for pattern, into in steps:
            total = total + count_of(c, pattern)
            c = F.regexp_replace(c, pattern, into)
        return total

    return Rule(name, apply, count)


def math_line_rule(name: str, pattern: str, into: str) -> Rule:
    """A replacement on lines of mathematics only."""

    def apply(c: Column) -> Column:
        return F.array_join(F.transform(lines(c), lambda x: F.when(x.rlike(pattern) & is_math_line(x), F.regexp_replace(x, pattern, into)).otherwise(x)), "\n")

    def count(c: Column) -> Column:
        per_line = F.transform(lines(c), lambda x: F.when(x.rlike(pattern) & is_math_line(x), count_of(x, pattern)).otherwise(F.lit(0).cast("bigint")))
        return F.coalesce(F.aggregate(per_line, F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(0).cast("bigint"))

    return guarded(Rule(name, apply, count), lambda c: c.rlike(pattern))


#: Marks of a finished proof, removed inside proofs only. Fixed patterns, in order.
PROOF = r"(?s)\\begin\{proof\}(.*?)\\end\{proof\}"
PROOF_MARKS = (
    r"\s*\\qed\b(?!here)",
    r"\s*\\hfill\s*\$\\blacksquare\$",
    r"\s*\$\\blacksquare\$",
    r"\s*\\hfill\s*\\\(\\blacksquare\\\)",
)


def _proof_rule() -> Rule:
    """Mask and rebuild: the parts outside proofs are kept, each proof's body is cleaned, both are interleaved again."""
    marks = pattern_rule("", *[(p, "") for p in PROOF_MARKS])

    def bodies(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit(PROOF), F.lit(1))

    def apply(c: Column) -> Column:
        outside = F.split(c, PROOF, -1)
        inside = F.transform(bodies(c), lambda b: F.concat(F.lit("\\begin{proof}"), marks.apply(b), F.lit("\\end{proof}")))
        return F.array_join(F.transform(F.arrays_zip(outside.alias("o"), inside.alias("i")), lambda p: F.concat(p["o"], F.coalesce(p["i"], F.lit("")))), "")

    def count(c: Column) -> Column:
        return F.coalesce(F.aggregate(F.transform(bodies(c), marks.count), F.lit(0).cast("bigint"), lambda a, b: a + b), F.lit(0).cast("bigint"))

    return Rule("duplicate_qed", apply, count)


def _boxed(env: str) -> tuple[str, str]:
    return (r"(?s)\\begin\{" + env + r"\}\s*(.*?)\s*\\end\{" + env + r"\}", r"\\boxed{$1}")


#: The rules in the order in which they run.
RULES: tuple[Rule, ...] = (
    guarded(pattern_rule("boxed_environment", _boxed("boxed")), holds("\\begin{boxed}")),
    guarded(pattern_rule("defbox_in_math", _boxed("defbox")), holds("\\begin{defbox}")),
    guarded(pattern_rule("double_math_boxed", (r"\\boxed\{\$([^$]+)\$\}", r"\\boxed{$1}")), holds("\\boxed{$")),
    guarded(pattern_rule("boxed_display_math", (r"(?s)\\boxed\{\\?\[\s*(.*?)\s*\\?\]\}", r"\\[\\boxed{$1}\\]")), holds("\\boxed{\\[", "\\boxed{[")),
    guarded(pattern_rule("missing_partial", (r"\\frac\{partial\}\{partial\s+(" + WORD + r")\}", r"\\frac{\\partial}{\\partial $1}")), holds("\\frac{partial}")),
    guarded(_proof_rule(), holds("\\qed", "\\blacksquare")),
    guarded(pattern_rule("undefined_control", (r"\\textup\b", r"\\textrm"), (r"\\bold\b", r"\\mathbf")), holds("\\textup", "\\bold")),
    math_line_rule("double_superscript", f"({WORD})\\^({WORD})\\^({WORD})", r"$1^{$2^{$3}}"),
    math_line_rule("double_subscript", f"({WORD})_({WORD})_({WORD})", r"$1_{$2_{$3}}"),
)

#: Patterns that are reported and never rewritten: too risky to repair without a reader.
DETECTORS = {"foreach_arithmetic": r"\\foreach\s+\\?\w+\s+in\s*\{[^}]*\+[^}]*\}"}


def rewritten(df: DataFrame, text: str = "content", rules: tuple[Rule, ...] = RULES, detectors: dict[str, str] = DETECTORS) -> DataFrame:
    """``df`` with ``text`` rewritten, one ``n_<rule>`` counter per rule, ``n_form_feed`` (1 per text that held form
    feeds), ``n_<detector>``, ``changed`` and ``total_fixes``: counters count only if the text changed, form feeds always."""
    feed = F.coalesce(F.instr(text, "\f") > 0, F.lit(False))
    out = df.withColumn("n_form_feed", feed.cast("bigint")).withColumn("__text", F.replace(F.col(text), F.lit("\f"), F.lit("")))
    out = out.withColumns({f"n_{k}": count_of(F.col("__text"), p) for k, p in detectors.items()}).withColumn("__before", F.col("__text"))
    for r in rules:
        out = out.withColumn(f"n_{r.name}", r.count(F.col("__text")))
        out = out.withColumn("__text", r.apply(F.col("__text")))
    changed = F.coalesce(F.col("__text") != F.col("__before"), F.lit(False))
    fixes = sum((F.col(f"n_{r.name}") for r in rules), F.lit(0).cast("bigint"))
    out = out.withColumn("changed", changed | F.col("n_form_feed").cast("boolean")).withColumn("total_fixes", F.col("n_form_feed") + F.when(changed, fixes).otherwise(0))
    return out.withColumn(text, F.col("__text")).drop("__text", "__before")


# --- removal between markers, checked again afterwards -------------------------------------------------------------
#: Scrub patterns: an imprint up to its closing line, a page up to a bound it may not cross, a page at the very end of a
#: text, a single line. Each is (pattern, replacement). Fixed patterns of the kinds of markers.
def bounded_block(start: str, end: str, never: str | None = None) -> tuple[str, str]:
    """Remove from ``start`` to the first ``end``, never across ``never``."""
    body = rf"(?:(?!{never})[\s\S])*?" if never else r"[\s\S]*?"
    return start + body + end, ""


def block_to_end(start: str, end: str) -> tuple[str, str]:
    """Remove from ``start`` to the ``end`` that closes the whole text."""
    return start + r"[\s\S]*?" + end + r"\s*\z", ""


def marked_line(start: str) -> tuple[str, str]:
    return rf"(?m)^{start}.*\n", ""


def scrubbed(texts: DataFrame, targets: DataFrame, patterns: dict[str, list[tuple[str, str]]], forbidden: tuple[str, ...], key: str = "rel_path", text: str = "content") -> DataFrame:
    """Targets (key, scrub) against texts: status ``absent``, ``unchanged``, ``scrubbed``, or ``failed`` where a forbidden
    marker is left afterwards, whatever was removed (fail closed)."""
    joined = targets.join(texts.select(key, F.col(text).alias("__old")), key, "left")
    new = F.col("__old")
    for name, steps in patterns.items():
        cleaned = F.col("__old")
        for p, into in steps:
            cleaned = F.regexp_replace(cleaned, p, into)
        new = F.when(F.col("scrub") == name, cleaned).otherwise(new)
    joined = joined.withColumn(text, new)
    left = F.lit(False)
    for p in forbidden:
        left = left | F.col(text).rlike(p)
    status = F.when(F.col("__old").isNull(), "absent").when(left, "failed").when(F.col(text) == F.col("__old"), "unchanged").otherwise("scrubbed")
    removed = F.coalesce(F.length("__old") - F.length(text), F.lit(0)).cast("bigint")
    return joined.select(key, "scrub", status.alias("status"), removed.alias("removed_chars"), text)
