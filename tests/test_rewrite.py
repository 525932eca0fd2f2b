"""Rewrite rules: recorded input and output of each rule, order, counters, nulls."""

import pytest
from pyspark.sql import functions as F

from quire.operators import rewrite
from quire.operators.checks import FORBIDDEN

VECTORS = [
    ("boxed_environment", r"\begin{boxed}x^2 + y^2\end{boxed}", r"\boxed{x^2 + y^2}", 1),
    ("boxed_environment", r"\boxed{x}", r"\boxed{x}", 0),
    ("defbox_in_math", r"\begin{defbox}E[X] = \mu\end{defbox}", r"\boxed{E[X] = \mu}", 1),
    ("double_math_boxed", r"\boxed{$a+b$}", r"\boxed{a+b}", 1),
    ("boxed_display_math", r"\boxed{\[a+b\]}", r"\[\boxed{a+b}\]", 1),
    ("missing_partial", r"\frac{partial}{partial x}", r"\frac{\partial}{\partial x}", 1),
    ("missing_partial", r"\frac{\partial}{\partial x}", r"\frac{\partial}{\partial x}", 0),
    ("duplicate_qed", "\\begin{proof}\nSome proof.\n\\qed\n\\end{proof}", "\\begin{proof}\nSome proof.\n\\end{proof}", 1),
    ("duplicate_qed", "\\begin{proof}\nDone.\n\\qedhere\n\\end{proof}", "\\begin{proof}\nDone.\n\\qedhere\n\\end{proof}", 0),
    ("duplicate_qed", "\\begin{proof}\nDone.\n\\hfill$\\blacksquare$\n\\end{proof}", "\\begin{proof}\nDone.\n\\end{proof}", 1),
    ("duplicate_qed", "\\qed outside \\begin{proof}a\\qed\\end{proof} \\qed", "\\qed outside \\begin{proof}a\\end{proof} \\qed", 1),
    ("undefined_control", r"\textup{hello}", r"\textrm{hello}", 1),
    ("undefined_control", r"\bold{x}", r"\mathbf{x}", 1),
    ("double_superscript", "x^2^3", "x^{2^{3}}", 1),
    ("double_subscript", "a_i_j", "a_{i_{j}}", 1),
    ("double_subscript", r"\includegraphics[width=0.8\textwidth]{figures/ch01/fig_1_2_1.png}", r"\includegraphics[width=0.8\textwidth]{figures/ch01/fig_1_2_1.png}", 0),
    ("double_subscript", r"\label{fig:1_2_3}", r"\label{fig:1_2_3}", 0),
    ("double_superscript", "\\input{ch01/sec01_2}", "\\input{ch01/sec01_2}", 0),
    ("double_subscript", "é_é_b", "é_{é_{b}}", 1),
]


def test_vectors(spark):
    rows = spark.createDataFrame([(i, v[1]) for i, v in enumerate(VECTORS)], "i int, content string")
    got = {r.i: r for r in rewrite.rewritten(rows).collect()}
    for i, (rule, _, expected, n) in enumerate(VECTORS):
        assert got[i].content == expected, (rule, got[i].content)
        assert got[i][f"n_{rule}"] == n


def test_nulls_form_feeds_and_totals(spark):
    rows = spark.createDataFrame([(1, None), (2, ""), (3, "a\fb"), (4, "x^2^3 \f \\bold{y}")], "i int, content string")
    got = {r.i: r for r in rewrite.rewritten(rows).collect()}
    assert got[1].content is None and got[1].total_fixes == 0 and not got[1].changed
    assert got[2].content == "" and got[2].total_fixes == 0
    assert got[3].content == "ab" and got[3].total_fixes == 1 and got[3].changed
    assert got[4].content == "x^{2^{3}}  \\mathbf{y}" and got[4].total_fixes == 3


def test_detector_reports_and_changes_nothing(spark):
    text = r"\foreach \x in {0,1+2}"
    r = rewrite.rewritten(spark.createDataFrame([(text,)], "content string")).first()
    assert r.n_foreach_arithmetic == 1 and r.content == text and r.total_fixes == 0


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], "content string, word string, n int, line string")
    assert rewrite.rewritten(df).count() == 0


def test_scrub_fails_closed(spark):
    texts = spark.createDataFrame([("a", "x\n- **Publisher**: P\ny ISBN 1\n"), ("b", "- **Publisher**: P\nend\n"), ("c", "nothing\n"), ("d", "% Copyright page\nall\n\\mainmatter\n\\cleardoublepage\n")], "rel_path string, content string")
    targets = spark.createDataFrame([("a", "line"), ("b", "line"), ("c", "line"), ("d", "page"), ("e", "line")], "rel_path string, scrub string")
    patterns = {"line": [rewrite.marked_line(r"- \*\*Publisher\*\*:")], "page": [rewrite.bounded_block(r"% Copyright page\n", r"\\cleardoublepage\n", r"\\mainmatter")]}
    got = {r.rel_path: (r.status, r.removed_chars) for r in rewrite.scrubbed(texts, targets, patterns, tuple(p for _, p in FORBIDDEN)).collect()}
    assert got["a"] == ("failed", 19)
    assert got["b"] == ("scrubbed", 19)
    assert got["c"] == ("unchanged", 0)
    assert got["d"] == ("unchanged", 0)  # the block may not cross the bound
    assert got["e"] == ("absent", 0)


@pytest.mark.parametrize("text,left", [("a\\thispagestyle b\\clearpage\n c\\clearpage \n", "a"), ("no mark", "no mark")])
def test_block_to_end(spark, text, left):
    p, into = rewrite.block_to_end(r"\\thispagestyle", r"\\clearpage")
    assert spark.createDataFrame([(text,)], "c string").select(F.regexp_replace("c", p, into)).first()[0] == left
