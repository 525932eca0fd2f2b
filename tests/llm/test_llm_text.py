"""Truncation, parsing, tokens, mixing, look-alikes: defined cases, brute force and exact round trips."""

import ast
import json
import os
import random
import re
import warnings
from datetime import datetime
from pathlib import Path

import pytest

from quire.llm import lookalike, mixing, parsing, peg, tokens, truncation

T0 = datetime(2024, 1, 1)
has_vocabulary = pytest.mark.skipif(not os.path.isdir(tokens.VOCAB_DIR), reason="no vocabulary files")


# --- parsing -----------------------------------------------------------------------------------------------------------
PYTHON = [
    "", "x = 1\n", "def f(a, *b, c=1, **d) -> int:\n    return a\n", "def f(:\n  pass\n", "if x:\npass\n", "print 'a'\n", "a = [1, 2\n", "x = {'a': 1, **b}\n", "async def f():\n    async with a as b, c:\n        await d\n",
    "f() = 3\n", "a + 1 = 2\n", "a, *b = c\n", "a: int = 3\n", "a.b[1:2, ::3] += 4\n", "lambda x, *y: x\n", "[x for x in y if z for w in x]\n", "x = yield\n", "def f():\n\tif a:\n\t\tpass\n\n\tb\n", "def f():\n    a\n  b\n",
    "try:\n    a\nexcept (B, C) as e:\n    d\nelse:\n    e\nfinally:\n    f\n", "try:\n    a\n", "match x:\n    case [1, *r] if r: pass\n    case {'a': b, **c} | D(e=1): pass\n", "match = 3\nprint(match)\n", "f'{a!r:>{w}} {\"x\"}'\n", "f'{f'{a}'}'\n", "x = '''a\nb'''\n", "x = 'a\n", "x = \"\"\"a\n", "<<<<<<< HEAD\n", "a if b else c\n", "not a in b is not c\n", "a not b\n",
    "from . import a\nfrom ..b import (c as d, e,)\nimport f.g as h\n", "from x import\n", "@a.b(c)\nclass D(E, metaclass=F):\n    x: int\n", "f(a=1, *b, **c)\n", "f(a for a in b)\n", "f(**a, b)\n", "0x1F + 1_000 + 1e-3j + .5\n", "1abc\n", "01a\n", "x = (\n  1 +\n  # c\n  2)\n", "a \\\n  + b\n", "a ! b\n", "while a: b; c\n", "with (a as b, c as d,): pass\n", "x := 3\n", "(x := 3)\n", "del a, b[0]\n", "global a, b\n", "assert a, b\n", "raise A from b\n", "return\n", "x = *a, b\n", "if (n := f()) > 1: pass\n", "é = 1\n", "{a: b for a, b in c}\n", "{1, 2, *c}\n", "type X[T] = list[T]\n", "def f[T: int](x: T): ...\n", "a = b = c\n", "1 = a\n", "x = 1 2\n", ")\n",
]


@pytest.mark.parametrize("text", PYTHON)
def test_python_grammar_agrees_with_the_language(text):
    try:
        ast.parse(text)
        valid = True
    except SyntaxError:
        valid = False
    if text:
        assert peg.check("py", text)[0] is valid


def test_python_grammar_on_cut_and_damaged_library_files():
    random.seed(1)
    for name in ("textwrap", "bisect", "contextlib", "dataclasses"):
        with open(__import__(name).__file__) as f:
            text = f.read()
        assert peg.check("py", text)[0]
        for _ in range(25):
            k = random.randrange(len(text))
            damaged = random.choice([text[:k], text[:k] + text[k + 1 :], text[:k] + random.choice("()[]{}:'\"") + text[k:]])
            try:
                ast.parse(damaged)
                valid = True
            except SyntaxError:
                valid = False
            assert peg.check("py", damaged)[0] is valid, (name, k)


@pytest.mark.parametrize("text", ['{"a": [1, 2.5e-3, "\\u00e9", true, null]}', " [] ", "{}", "[1,]", '{"a":1,}', "{'a':1}", "01", "-", "1 2", '"a\nb"', "nul", '{"a" 1}', "[" * 3000 + "]" * 3000, "[" * 500])
def test_json_grammar(text):
    try:
        json.loads(text)
        valid = True
    except RecursionError:
        valid = text.count("[") == text.count("]")
    except ValueError:
        valid = False
    assert peg.check("json", text)[0] is valid


@pytest.mark.parametrize("text,valid", [
    ("# c\n\nA=1\nB=\"x y\"\nC='z'\nD=\n", True), ("A = 1\n", False), ("A=x y\n", False), ("A=\"x\n", False), ("A=x\"\n", False), ("<<<<<<< HEAD\n", False), ("A : 1\n", False), ("A", False), ("A=1\r\nB=2", True),
])
def test_conf_grammar(text, valid):
    assert peg.check("conf", text)[0] is valid


@pytest.mark.parametrize("text,valid", [
    ("a $x$ \\[ y \\] \\( z \\) $$w$$", True), ("a $x", False), ("\\begin{a}\\begin{b}\\end{a}\\end{b}", False), ("{ $ } $", False), ("% { $ \\begin{x}\n", True), ("\\verb|{$| \\{ \\$ \\%", True),
    ("\\begin{verbatim}{ $ \\end{x}\n=======\n\\end{verbatim}", True), ("a\n=======\nb", False), ("a\n======== b\n", True), ("\\\\[0.5em] x", True), ("\\[ a", False), ("\\] a", False), ("}", False), ("\\left\\{ x \\right\\}", True), ("import os\n\ndef f(x):\n    return x\n", False), ("A_B=\"1\"\nC=2\n", False),
    ("{" * 4000 + "}" * 4000, True), ("{" * 4000, False), ("plain words", True),
])
def test_latex_grammar(text, valid):
    assert peg.check("tex", text)[0] is valid


def test_parsed_rows_rates_and_odd_rows(spark):
    rows = [(1, "b", "py", T0, "x = (\n"), (1, "b", "py", T0, "x = (\n"), (2, "b", "json", T0, "[1]"), (3, "b", "tex", T0, None), (4, None, "tex", T0, ""), (5, "b", "md", T0, "{"), (6, "b", None, T0, "x"), (7, "b", "tex", T0, "ok\n<<<<<<< HEAD\n")]
    f = spark.createDataFrame(rows, "file_id long, book string, suffix string, loaded_at timestamp, content string").selectExpr("*", "1 as valid")
    assert sorted(r.file_id for r in parsing.found(f).collect()) == [1, 7]
    by = {r.file_id: r for r in parsing.parsed(f).collect()}
    assert len(by) == 7 and not by[3].checked and not by[5].checked and by[1].cause == "truncated" and by[7].cause == "conflict" and by[7].fail_line == 2
    total = {r.suffix: (r.files, r.checked, r.invalid, r.rate) for r in parsing.rates(f).where("all_books").collect()}
    assert total["tex"] == (3, 1, 1, 1.0) and total["py"] == (1, 1, 1, 1.0)
    assert parsing.found(f.limit(0)).count() == 0


# --- truncation ----------------------------------------------------------------------------------------------------------
def _files(spark, rows):
    return spark.createDataFrame([(i, s, o, T0, c) for i, s, o, c in rows], "file_id long, suffix string, origin string, loaded_at timestamp, content string")


RESULTS = "result_id long, model string, input_format string, status string, output_length int, output_tail string, loaded_at timestamp"


def test_truncation(spark):
    rows = [(i, "tex", "form", f"{i} " + "w" * 48) for i in range(5)]  # all at the limit of their origin
    rows += [(10 + i, "tex", "form", "A whole sentence.\n" * (i % 2 + 1)) for i in range(8)]
    rows += [(20, "tex", "mail", "A sentence that sto"), (21, "tex", "mail", "All said."), (22, "tex", "mail", "x\n\\end{proof}"), (23, "tex", None, None), (24, "tex", "mail", ""), (25, "json", "mail", '[{"a": "b'), (26, "json", "mail", "[1]"), (27, "conf", "mail", "A=1\nB=\"x"), (28, "conf", "mail", "A=1\nB=\"x\""), (29, "py", "mail", "x = [1,"), (30, "tex", "mail", "\\item Show that"), (31, "tex", "mail", "\\item Show that\n")]
    rows += [(20, "tex", "mail", "A sentence that sto")]
    res = [(i, "m", "f", "Success", 100, "tail cut in the mid", T0) for i in range(4)] + [(10 + i, "m", "f", "success", 20 + i, "Whole.", T0) for i in range(6)] + [(20, "m", "f", "success", 33, "cut in the mid", T0), (21, "m", "f", "error", 0, None, T0), (22, "m", "f", "success", 41, None, T0), (23, "m", "f", "success", 100, None, T0)]
    r = spark.createDataFrame(res, RESULTS)
    got = truncation.found(_files(spark, rows), r)
    assert got.columns == ["tbl", "rec_id"]
    got = {(x.tbl, x.rec_id) for x in got.collect()}
    assert {i for t, i in got if t == "source_file"} == {0, 1, 2, 3, 4, 20, 25, 27, 29, 30}
    assert {i for t, i in got if t == "filter_test_result"} == {0, 1, 2, 3, 20, 23}
    rate = {x.source: x for x in truncation.source_rates(_files(spark, rows), r).collect()}
    assert rate['{"origin":"form"}'].at_limit == 5 and rate['{"origin":"form"}'].char_limit == 50
    assert truncation.found(_files(spark, []), r.limit(0)).count() == 0


def test_byte_limit_before_a_wide_character(spark):
    rows = [(i, "tex", "web", "é" * 19 + "éèêàçô"[i]) for i in range(6)] + [(9, "tex", "web", "x" + "é" * 19), (10, "tex", "web", "short.\n"), (11, "tex", "other", "é" * 30 + ".")]
    rows += [(20 + i, "tex", "web", "a" * 39 + "bcde"[i]) for i in range(4)]
    got = {x.rec_id for x in truncation.found(_files(spark, rows), spark.createDataFrame([], RESULTS)).collect()}
    assert got == {0, 1, 2, 3, 4, 5, 9, 20, 21, 22, 23}


def test_every_spike_near_the_greatest_length(spark):
    """Two limits of one source, copies of one content, and a complete value that stands at a limit."""
    text = lambda i, n, end="": (f"{i} " + "word " * n)[: n - len(end)] + end
    rows = [(i, "tex", "form", text(i, 400)) for i in range(12)] + [(20 + i, "tex", "form", text(i, 300)) for i in range(11)]
    rows += [(40, "tex", "form", text(40, 400, ".")), (41, "tex", "form", text(41, 390, ".\n"))]
    rows += [(50 + i, "tex", "git", "A copied file.\n" * 20) for i in range(30)] + [(90, "tex", "git", "x.\n" * 120)]
    got = truncation.cases(_files(spark, rows), spark.createDataFrame([], RESULTS)).collect()
    assert {(x.rec_id, x.sign, x.unit, x["at"], x.complete) for x in got} == {*((i, "limit", "chars", 400, False) for i in range(12)), *((20 + i, "limit", "chars", 300, False) for i in range(11)), (40, "limit", "chars", 400, True)}


# --- tokens --------------------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def encoder():
    with open(os.path.join(tokens.VOCAB_DIR, tokens.VOCAB), "rb") as f:
        return tokens.Encoder(f.read())


def ids_of(enc, text):
    (words,) = enc.encode([text])
    return [i for w in words for i in enc.known[w]]


@has_vocabulary
def test_ids_equal_the_library(encoder):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(os.path.join(tokens.VOCAB_DIR, tokens.VOCAB))
    t.encode_special_tokens = True
    random.seed(2)
    alphabet = "abcdefgh  \n\t'éß中🙂𝔸0123456789.,<|>\\{}_ѕ\u200b"
    texts = ["".join(random.choice(alphabet) for _ in range(random.randrange(1, 80))) for _ in range(300)]
    texts += ["a" * 500, " " * 300 + "x", "<|endoftext|>", "it's we'll I'M", "\r\n\r\n", "x" * 63, "ab" * 32, "the" * 400, "\u3000 \xa0x"]
    for text in texts:
        assert ids_of(encoder, text) == t.encode(text, add_special_tokens=False).ids, text


@has_vocabulary
def test_heap_and_query_agree(encoder):
    random.seed(3)
    for _ in range(100):
        w = "".join(random.choice("aabbthe er") for _ in range(random.randrange(1, tokens.LONG))).replace(" ", "n")
        encoder.known.pop(w, None)
        encoder.learn([w])
        assert encoder.known[w] == encoder.by_heap([encoder.byte_id[b] for b in w.encode()])


@has_vocabulary
def test_ids_of_a_table(spark):
    df = spark.createDataFrame([(1, "Hello world"), (2, None), (3, ""), (4, " \n "), (1, "Hello world")], "doc_id long, text string").selectExpr("*", "'x' as ids")
    got = sorted((r.doc_id, r.ids) for r in tokens.token_ids(df).collect())
    assert got[0] == got[1] == (1, [15496, 995]) and got[2] == (2, []) and got[3] == (3, []) and len(got[4][1]) > 0
    counts = {r.doc_id: r.n_tokens for r in tokens.token_counts(df, ["doc_id"]).collect()}
    assert counts == {1: 2, 2: 0, 3: 0, 4: len(got[4][1])}
    assert tokens.token_ids(df.limit(0)).count() == 0


# --- mixing --------------------------------------------------------------------------------------------------------------
def test_mix_meets_targets(spark):
    sizes = [(i, "a", 10 + i % 5) for i in range(20_000)] + [(20_000 + i, "b", 50) for i in range(3_000)] + [(30_000 + i, "c", 0) for i in range(5)] + [(40_000, None, 5)]
    s = spark.createDataFrame(sizes, "doc_id long, source string, n_tokens long")
    t = spark.createDataFrame([("m", "a", 0.25, 2), ("m", "b", 0.7, 4), ("m", "gone", 0.05, 3), ("n", "a", 0.5, 1), ("n", "a", 0.5, 2), (None, "a", 1.0, 1), ("o", "c", 1.0, 2)], "mix_name string, source string, target_share double, max_repeats int")
    r = mixing.rates(s, t, mixing.EXACT)
    picked = mixing.chosen(s, r)
    shares = {(x.mix_name, x.source): x for x in mixing.shares(picked, r).collect()}
    assert abs(shares[("m", "a")].actual_share - 0.25 / 0.95) < 0.01 and abs(shares[("m", "b")].actual_share - 0.7 / 0.95) < 0.01
    assert shares[("m", "gone")].rate is None and shares[("m", "gone")].actual_share == 0
    assert shares[("n", "a")].documents == 20_000 and shares[("n", "a")].most_repeats == 1 and shares[("o", "c")].documents == 0
    assert max(x.repeats for x in picked.where("source = 'b'").collect()) <= 4
    again = mixing.chosen(s.repartition(7), r)
    assert picked.exceptAll(again).count() == 0
    assert mixing.chosen(s.limit(0), mixing.rates(s.limit(0), t)).count() == 0


def test_mix_of_all_tokens_reports_what_caps_keep_short(spark):
    sizes = [(i, "a", 12) for i in range(20_000)] + [(20_000 + i, "b", 50) for i in range(3_000)]
    s = spark.createDataFrame(sizes, "doc_id long, source string, n_tokens long")
    t = spark.createDataFrame([("m", "a", 0.25, 2), ("m", "b", 0.75, 1), ("n", "a", 0.5, 2), ("n", "b", 0.5, 4), ("n", "gone", 0.0, 1)], "mix_name string, source string, target_share double, max_repeats int")
    r = mixing.rates(s, t)
    got = {(x.mix_name, x.source): x for x in mixing.shares(mixing.chosen(s, r), r).collect()}
    b = got[("m", "b")]  # 390,000 tokens are listed: b should give 292,500 and has 150,000
    assert (b.rate, b.documents, b.mix_tokens, b.shortfall_tokens) == (1.0, 3000, 150_000, 142_500.0)
    assert abs(got[("m", "a")].mix_tokens - 97_500) < 2500 and got[("m", "a")].shortfall_tokens == 0
    assert abs(got[("n", "a")].actual_share - 0.5) < 0.01 and got[("n", "b")].shortfall_tokens == 0 and got[("n", "gone")].rate is None
    small = mixing.rates(s, t, 10_000)
    rows = mixing.shares(mixing.chosen(s, small), small).where("mix_name = 'n'").collect()
    assert abs(sum(x.mix_tokens for x in rows) - 10_000) < 1500


@has_vocabulary
def test_round_trip(spark):
    texts = [(1, "Hello world"), (2, None), (3, ""), (4, " \n "), (5, "é中🙂𝔸\u200b" * 40), (6, "a" * 700 + " " * 600 + "x"), (7, "<|endoftext|>")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    assert {r.doc_id: r.text for r in tokens.decoded(tokens.token_ids(df)).collect()} == {k: t or "" for k, t in texts}
    assert tokens.decoded(tokens.token_ids(df.limit(0))).count() == 0


def test_letters_alike_in_company(spark):
    """Scores decide: a Greek or Cyrillic letter in a Latin word is read as Latin, a word of its own script stays."""
    docs = ["the kernel of the operator is a power", "the кernel of the oρerator is a ρower", "как рок и кот", "κύκλος ρο", "k and к", "the kernel of the operator is a power", "ρ is a density"]
    df = spark.createDataFrame(list(enumerate(docs * 1)), "doc_id long, text string")
    forms = {r.doc_id: r.consistent for r in lookalike.consistent(df).collect()}
    assert forms[1] == docs[0] and lookalike.classes(docs[1]) != docs[0]
    assert all(forms[k] == docs[k] for k in (2, 3, 4, 6))
    assert sorted(map(tuple, lookalike.same_looking(df).collect())) == [(0, 1), (1, 5)]


# --- look-alikes ---------------------------------------------------------------------------------------------------------
SAME = [("Ｆｕｌｌ１", "Full1"), ("ﬁne", "fine"), ("café", "cafe\u0301"), ("a\u200bb\ufeff", "ab"), ("a\u2007b", "a b"), ("periodiс", "periodic"), ("ѕо", "so"), ("Ηello", "Hello"), ("ё", "е\u0308"), ("ë", "е\u0308"), ("a\r\nb", "a\nb"), ("co\u00adop", "coop"), ("сор", "cop")]
OTHER = [("A", "a"), ("naive", "naïve"), ("x²", "x2"), ("a b", "ab"), ("л", "n"), ("½", "1/2"), ("O", "0")]


def test_classes():
    for a, b in SAME:
        assert lookalike.classes(a) == lookalike.classes(b), (a, b)
    for a, b in OTHER:
        assert lookalike.classes(a) != lookalike.classes(b), (a, b)


def test_forms_depend_on_looks_alone_and_words_keep_their_script():
    russian = ["Отсюда плотность симметрична, а функция остаётся выпуклой", "о сор и рост у моря"] * 20
    reader = lookalike.Reader(dict(lookalike.count_pairs(russian + ["the compact covering of a sparse operator"] * 40)))
    read = lambda t: reader.read(lookalike.classes(t))
    assert read("Отсюда плотность симметрична, а функция") == "Отсюда плотность симметрична, а функция"
    assert read("Отcюдa плoтнocть") == "Отсюда плотность"  # Latin letters in Russian words
    assert read("the соmраct соvеring") == "the compact covering"
    assert read("сорe") == "cope" and read("ﬁeld α ≤ β") == "field α ≤ β"
    random.seed(4)
    members = {row[0]: [x for x in row if x] for row in lookalike._ROWS}
    for text in [*russian[:2], "Some spаrse operator α, cop", "пример A B C, see e.g. а о у"]:
        seen = lookalike.classes(text)
        for _ in range(20):
            other = "".join(random.choice(members.get(c, [c])) for c in seen)
            assert read(other) == read(text)


def test_pairs_of_a_table(spark):
    rows = [(1, "сovering"), (2, "covering"), (3, "covering"), (4, "Covering"), (5, None), (6, ""), (7, " "), (8, "\u2007"), (9, "ｃovering")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'f' as form")
    got = sorted((r.a, r.b) for r in lookalike.same_looking(df).collect())
    assert got == [(1, 2), (1, 3), (1, 9), (2, 9), (3, 9)]
    forms = {r.doc_id: r.consistent for r in lookalike.consistent(df).collect()}
    assert forms[1] == forms[9] == "covering" and forms[5] is None and forms[6] == ""
    assert lookalike.same_looking(df.limit(0)).count() == 0


REJECTED = [
    "0777", "def f(a=1, b): pass", "def f(*): pass", "def f(a, /, b, /): pass", "def f(*a, *b): pass", "def f(**k, a): pass", "lambda a=1, b: 0", "f(**a, *b)", "f(x for x in y, 1)", "f(1, x for x in y)",
    "class A(x for x in y): pass", "b'a' 'b'", "'\\x'", "'\\N{zz}'", "'\\u12'", "b'\u00e9'", "f'{1 +}'", "f'{}'", "f'{x'", "f'}'", "f'{x!z}'", "f'{a b}'", "if 1:\n\tx = 1\n        y = 2\n", "(*a for a in b)", "{**a for a in b}", "(]", "x = )",
]
ACCEPTED = [
    "f'{x!r:>{w}}'", "f'{x=}'", "f'{x = !r}'", "f\"{d['a']}\"", "f'{{}}'", "f'{a!=b}'", "f'{a:=^10}'", "f'{(lambda x: 1)}'", "f'{f\"{x}\"}'", "rf'\\d{x}'", "f'\\N{EN DASH}{x}'", "def f(a, /, b=1, *, c, d=2, **k): pass", "def f(a=1, /, b=2): pass",
    "f(*a, b, c=1, *d, **e, g=2)", "f(x for x in y)", "00", "0777.5", "{**a, 'b': 1}", "x[a:b, *c]", "print(f'{a!r}' 'b')",
]


@pytest.mark.parametrize("text,valid", [*((t, False) for t in REJECTED), *((t, True) for t in ACCEPTED)])
def test_python_snippets(text, valid):
    assert peg.check("py", text)[0] is valid


def test_python_grammar_on_mutated_tokens():
    """Tokens of this library's own files, put in, taken out and replaced at random: the language's own parser decides."""
    random.seed(3)
    files = [f.read_text() for f in sorted(Path(peg.__file__).parents[1].rglob("*.py")) if f.stat().st_size > 500]
    tokens = re.findall(r"\w+|[^\w\s]|\n *", "".join(files[:6]))
    seen = 0
    for _ in range(400):
        lines = random.choice(files).split("\n")
        a = random.randrange(len(lines))
        text = "\n".join(lines[a : a + random.randrange(3, 15)]).replace("\n" + " " * (len(lines[a]) - len(lines[a].lstrip())), "\n").lstrip() + "\n"
        for _ in range(random.randrange(0, 3)):
            k = random.randrange(len(text))
            text = text[:k] + (" " + random.choice(tokens) + " " if random.random() < 0.7 else "") + text[k + random.randrange(0, 4) :]
        try:
            with warnings.catch_warnings():
                warnings.simplefilter("ignore")
                ast.parse(text)
            valid = True
        except (SyntaxError, ValueError):
            valid = False
        seen += valid
        assert not text.strip() or peg.check("py", text)[0] is valid, text
    assert seen > 20


def test_another_language_is_told_by_its_grammar():
    assert peg.check("tex", "class of functions:\nand a plain text")[0]
    assert peg.check("tex", "import of goods, from x to y\nA=b, say\n")[0]
    for text, name in (("x = [1, 2]\nfor i in x:\n    print(i)\n", "py"), ('{"a": [1, 2]}\n', "json"), ("A=b\n# c\nC='d'\n", "conf")):
        ok, far, want, conflict = peg.check("tex", text)
        assert (ok, far, want, conflict) == (False, 0, f"LaTeX, not {name}", False)
    assert peg.check("json", "NaN")[1:3] == (0, "open")
