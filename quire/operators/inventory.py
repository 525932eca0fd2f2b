"""Structural counts with roll-ups and top terms. Null texts count 0; null groups are groups of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import count_of

#: Structural elements of LaTeX. Fixed patterns; ``exercises`` counts every ``\item``, as it is customary there.
ELEMENTS = {
    "sections": r"\\section\{",
    "equations": r"\\begin\{(?:equation|align|gather|multline)\*?\}",
    "figures": r"\\begin\{figure\}",
    "exercises": r"\\item",
}
STRICT = {"exercises": r"\\item(?![A-Za-z])"}
#: What is easily misread in mathematics: Greek letters, accents, bold macros; subscripted letters. Fixed patterns.
SYMBOLS = (
    r"\\(?:alpha|beta|gamma|delta|epsilon|varepsilon|zeta|eta|theta|vartheta|iota|kappa|lambda|mu|nu|xi|rho|varrho|sigma|varsigma|tau|upsilon|phi|varphi"
    r"|chi|psi|omega|Gamma|Delta|Theta|Lambda|Xi|Pi|Sigma|Upsilon|Phi|Psi|Omega|hat|bar|tilde|dot|ddot|bf[A-Za-z]+)\b"
)
SUBSCRIPTS = r"[A-Za-z]_\{?[0-9A-Za-z]+\}?"


def element_counts(files: DataFrame, text: str = "content", elements: dict[str, str] = ELEMENTS) -> DataFrame:
    """``files`` with one count column per element in place of the text: what is shuffled later is numbers."""
    return files.select("*", *[count_of(F.col(text), p).alias(n) for n, p in elements.items()]).drop(text)


def rolled_up(counts: DataFrame, groups: list[str], sums: list[str]) -> DataFrame:
    """Sums per group, per prefix of the groups and in total; ``level`` is how many groups a row has."""
    level = sum((1 - F.grouping(g) for g in groups), F.lit(0))
    return counts.rollup(*groups).agg(*[F.sum(s).alias(s) for s in sums], level.cast("int").alias("level"))


def top_terms(texts: DataFrame, text: str, pattern: str, groups: list[str], k: int) -> DataFrame:
    """The ``k`` most frequent matches (ties by the term) of each group, or overall. The terms of each group are counted
    with a partial aggregate before anything is ranked; a group's ranking keeps at most ``k`` rows of a partition."""
    return top_of(texts.withColumn(text, terms_of(F.col(text), pattern)), text, groups, k)


def terms_of(text: Column, pattern: str) -> Column:
    """The matches in a text: what is shuffled of it where only they are asked for."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def top_of(rows: DataFrame, terms: str, groups: list[str], k: int) -> DataFrame:
    """``top_terms`` of rows whose column ``terms`` holds the matches."""
    terms = rows.select(*groups, F.explode(terms).alias("term"))
    counts = terms.groupBy(*groups, "term").agg(F.count("*").alias("n"))
    if not groups:
        return counts.orderBy(F.desc("n"), "term").limit(k)
    from pyspark.sql import Window

    w = Window.partitionBy(*groups).orderBy(F.desc("n"), "term")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
