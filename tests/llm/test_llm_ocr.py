"""Repair of scanned pages: layout, hyphens, misread words, paragraphs, odd rows."""

import random

import pytest

from quire.llm import ocr
from quire.llm.queries import oracle_sql, queries

PAGES = "ocr_id long, pdf string, page_num int, text string, word string"
SECTIONS = "book string, chapter int, section_no int, title string, page_no int"
CHAPTERS = "book string, chapter int, title string, start_page int, end_page int"

BODY = [
    "The harmonic operator of the covering satisfies every linear condition and it",
    "preserves the self-adjoint matrices of the previous lemma. Applied to measures the",
    "theorem gives a compact distribution with several symmetric factorizations there.",
]


def book(n=12):
    """A small book: running titles with numbers, a footer, body, damage on page 5 and 6."""
    pages = {}
    for p in range(1, n + 1):
        top = f"{p} CHAPTER 1. COMPACT MEASURES" if p % 2 else f"1.2. LINEAR OPERATORS {p}"
        pages[p] = [top, "", *BODY, "", *BODY, "", "Working copy no. 7"]
    pages[5][2] = "The harm0nic operator of the covcring satisfies every linear condition and it"
    pages[5][3:5] = ["preserves the self-", "adjoint matrices of the previous lemma. Applied to meas-", "ures the theorem gives a compact distribution with several symmetric factoriza-", "tions there."]
    pages[6][8] = "theorem gives a compact distribution with several symmetric factoriza-"
    pages[7][2] = "tions there. The harmonic operator of the covering satisfies every linear"
    return pages


def found(spark, rows, sections=(), chapters=()):
    r = ocr.Repair(spark.createDataFrame(rows, PAGES), spark.createDataFrame(list(sections), SECTIONS), spark.createDataFrame(list(chapters), CHAPTERS))
    return r, {(x.ocr_id, x.line_no, x.kind) for x in r.found().collect()}


def test_book(spark):
    rows = [(p, "pdfs/b.pdf", p, "\n".join(t), "w") for p, t in book().items()]
    rows += [rows[4], (100, "pdfs/b.pdf", 13, None, "w"), (101, "pdfs/b.pdf", 14, "", "w"), (102, None, 1, "One line only", "w"), (103, "pdfs/c.pdf", None, "  \n ", "w")]
    r, got = found(spark, rows)
    for p, t in book().items():
        assert (p, 1, "header") in got and (p, len(t), "header") in got
    assert (5, 3, "misread") in got
    assert {(i, n) for i, n, k in got if k == "hyphen"} == {(5, 5), (5, 6), (6, 9)}
    assert {i for i, _, k in got if k == "misread"} == {5}
    texts = {x.ocr_id: x for x in r.texts().collect()}
    assert len(texts) == 16 and texts[100].text is None and texts[101].text == "" and texts[102].text == "One line only"
    page = texts[5].text
    assert "harmonic operator of the covering satisfies" in page and "self-adjoint matrices" in page and "measures the" in page and "symmetric factorizations there." in page
    assert "COMPACT" not in page and "Working" not in page
    assert texts[6].text.endswith("symmetric factorizations") and texts[7].text.startswith("there. The harmonic")
    assert len(texts[1].paragraphs) == 2


@pytest.mark.parametrize("indent", ["", "   ", "\t"])
def test_long_edge_lines(spark, indent):
    """Pages without line ends: a word broken at the page's end is joined whatever the lines' length."""
    prose = " ".join(BODY * 3)
    rows = [(1, "pdfs/b.pdf", 1, f"{indent}{prose} It is a symmetric factori-", "w"), (2, "pdfs/b.pdf", 2, f"{indent}zations there. {prose}", "w"), (3, "pdfs/b.pdf", 3, "\n".join(BODY * 3), "w"), (4, "pdfs/b.pdf", 4, "Symmetric factorizations there.", "w")]
    r, got = found(spark, rows)
    assert {(i, n) for i, n, k in got if k == "hyphen"} == {(1, 1)}
    texts = {x.ocr_id: x.text for x in r.texts().collect()}
    assert texts[1] == f"{prose} It is a symmetric factorizations" and texts[2] == f"there. {prose}"


def test_long_edge_lines_keep_what_is_read_of_them():
    prose = " ".join(BODY * 3)
    for line in (f"  page 12 {prose} meas-", f"- {prose} f = g {prose} 12 -", f"{prose} (end).", "-" * 400, "-" * 200 + " 12 " + "-" * 200, "12" + " " * 400, "x" * 400 + " y " + "z" * 400 + "-", "a" * 900):
        got, want = ocr.edge_line(line), line.rstrip()
        assert got.split()[0] == want.split()[0] and got.split()[-1] == want.split()[-1]
        assert got[: len(got) - len(got.lstrip())] == want[: len(want) - len(want.lstrip())] and ("=" in got) == ("=" in want) and (len(got) >= 200) == (len(want) >= 200)
        core, whole = ocr._ORNAMENT.sub("", got).split(), ocr._ORNAMENT.sub("", want).split()
        assert core[:1] == whole[:1] and core[-1:] == whole[-1:] and (len(core) == 1) == (len(whole) == 1)
    assert len(ocr.edge_line(prose * 100)) < 400


def test_pages_without_a_pdf_have_no_neighbours(spark):
    """Documents without a pdf and with equal or next page numbers: no word is joined, no title found across them."""
    rows = []
    for doc, tail, head in ((1, "factoriza-", "A linear"), (2, "meas-", "The compact")):
        for p in (1, 2):
            last = f"theorem gives a compact distribution with several symmetric {tail}" if p == 1 else BODY[2]
            rows.append((10 * doc + p, None, p, "\n".join([f"{head} title here it is,", "the same in all, of the book", *BODY, *BODY[:2], last, "the note at the end of pages"]), "w"))
    rows = [(i, d, p, t if p == 2 else t.rsplit("\n", 1)[0], w) for i, d, p, t, w in rows]
    rows += [(100, "pdfs/b.pdf", 1, "\n".join([*BODY, "symmetric factorizations of measures"]), "w")]
    r, got = found(spark, [*rows, rows[0]])
    tails = {x.ocr_id: x.tail for x in r.layout.collect()}
    assert len(tails) == 5 and {i for i, t in tails.items() if t is not None} == {11, 21}
    assert all(t.next_id is None and t.right is None for t in tails.values() if t is not None)
    alone = {c for row in rows for c in found(spark, [row])[1] if c[2] in ("header", "page_number")}
    assert {c for c in got if c[2] in ("header", "page_number")} == alone
    texts = {x.ocr_id: x.text for x in r.texts().collect()}
    assert texts[12].startswith("A linear title") and texts[22].startswith("The compact title")


def test_words_beside_pick_the_line_and_the_repair_of_a_broken_word(spark):
    """Two candidates repair different halves: by count alone the more frequent one would stand."""
    prose = ["They saw the hockey of the others there."] * 30 + ["The first alpha bockcy beta was seen there."] * 20
    for tail, head in (("hoc-\n", "kcy beta was found there."), ("hoc-", "kcy beta was found there.")):
        rows = [(1, "pdfs/b.pdf", 1, "\n".join([*prose, "The second alpha " + tail + (head if tail[-1] == "\n" else "")]), "w")]
        if tail[-1] != "\n":
            rows.append((2, "pdfs/b.pdf", 2, "\n".join([head, *prose]), "w"))
        r, got = found(spark, rows)
        assert {c for c in got if c[2] in ("misread", "hyphen")} == {(1, 51, "misread"), (1, 51, "hyphen")}
        assert "The second alpha bockcy" in {x.ocr_id: x.text for x in r.texts().collect()}[1]


def test_two_scans_of_a_page_and_absurd_ranges(spark):
    last = "theorem gives a compact distribution with several symmetric factoriza-"
    one = "\n".join([*BODY, last])
    rows = [(1, "pdfs/b.pdf", 1, one, "w"), (2, "pdfs/b.pdf", 1, one + " ", "w"), (3, "pdfs/b.pdf", 2, "\n".join(["tions there. A linear", *BODY]), "w"), (4, "pdfs/b.pdf", 3, "Symmetric factorizations there.", "w")]
    r, got = found(spark, rows, chapters=[("b", 1, "Compact measures", 1, 2**31 - 1), ("b", 2, "Linear", -(2**31), 5)])
    assert {(i, n) for i, n, k in got if k == "hyphen"} == {(1, 4), (2, 4)}
    texts = {x.ocr_id: x.text for x in r.texts().collect()}
    assert texts[1].endswith("symmetric factorizations") and texts[2].endswith("symmetric factorizations") and texts[3].startswith("there. A linear")


def test_keys_of_short_words_are_their_own():
    words = [a + b for a in "abcdefghijklmnop" for b in "abcdefghijklmnop"]
    share = sum(bool(ocr.delete_keys("it") & ocr.delete_keys(w)) for w in words)
    assert share < 40 and all(ocr.delete_keys(x) & ocr.delete_keys(y) for x, y in (("1t", "it"), ("%t", "it"), ("rn", "m"), ("cl", "d")))


def test_words_beside_a_formula(spark):
    """A misread word of a line with a formula is found and repaired; the formula itself holds none."""
    prose = ["The estimator converges and the estimator of the harmonic operator converges."] * 9
    rows = [(1, "pdfs/b.pdf", 1, "\n".join([*prose, "for x = 3 the estirnator converges, and f(x)=c0nverges_1 + tne of 0f", "tbe(x) = 0f + t0", *prose]), "w")]
    r, got = found(spark, rows)
    assert {(n, k) for _, n, k in got} == {(10, "misread")}
    text = r.texts().collect()[0].text
    assert "for x = 3 the estimator converges, and f(x)=c0nverges_1 + tne of 0f tbe(x) = 0f + t0" in text
    whole, broken = ocr.count_words(["the value x = 3 gives the esti-\nmator f(y) = 2"])
    assert broken["estimator"] == 1 and whole["value"] == 1 and "x" not in whole and "esti-" not in whole


def test_empty(spark):
    r, got = found(spark, [])
    assert got == set() and r.texts().count() == 0


def test_page_numbers_and_headings(spark):
    rows = []
    for p in range(10, 20):
        head = ["1.4 The covering lemma", ""] if p == 14 else []
        rows.append((p, "pdfs/b.pdf", p, "\n".join([*head, *BODY, "", f"- {p - 5} -"]), "w"))
    rows.append((50, "pdfs/b.pdf", 20, "\n".join([*BODY, "", "12345", "67890", "", *BODY, "15"]), "w"))
    _, got = found(spark, rows, sections=[("b", 1, 4, "The covering lemma", 14)])
    assert {(i, n) for i, n, k in got if k == "page_number"} == {(p, 7 if p == 14 else 5) for p in range(10, 20)} | {(50, 11)}
    assert not any(k == "header" for _, _, k in got)


@pytest.mark.parametrize("read,printed", [("likelibood", "likelihood"), ("recogriize", "recognize"), ("optirnization", "optimization"), ("c1osure", "closure"), ("den5ity", "density"), ("multiphers", "multipliers"), ("cliisters", "clusters"), ("inyerse", "inverse")])
def test_one_misreading(read, printed):
    assert ocr.misreading(read, printed)[0] == pytest.approx(0.2)
    assert ocr.delete_keys(read) & ocr.delete_keys(printed)


@pytest.mark.parametrize("read,printed", [("1nteri0r", "interior"), ("irnpl!citly", "implicitly"), ("e5tirnation", "estimation"), ("po5itiye", "positive")])
def test_several_misreadings_share_a_key(read, printed):
    assert ocr.delete_keys(read) & ocr.delete_keys(printed)
    assert ocr.several(read, printed) is not None


@pytest.mark.parametrize("read,printed", [("matrix", "metric"), ("pivots", "pivot"), ("norm", "form"), ("lemma", "lemma"), ("a", "b")])
def test_other_words_are_no_misreadings(read, printed):
    assert ocr.misreading(read, printed) is None


def test_candidates_equal_brute_force(spark):
    random.seed(6)
    good = ["operator", "covering", "measure", "implicit", "harmonic", "likelihood", "inverse", "recognize", "cluster"]
    rows = [(w, 100, 0) for w in good]
    for w in good:
        for read, printed in random.sample(sorted(ocr.PAIRS), 25):
            if printed in w:
                rows.append((w.replace(printed, read, 1), 1, 0))
    rows = list({w: (w, n, b) for w, n, b in rows[::-1]}.values())
    table = spark.createDataFrame(rows, "word string, n long, broken long")
    got = {(r.word, r.repair) for r in ocr.repairs(table).collect()}
    want = {(w, g) for w, n, _ in rows for g in good if w != g and n == 1 and (ocr.misreading(w, g) or ocr.several(w, g)) and ocr.delete_keys(w) & ocr.delete_keys(g)}
    assert got == want and len(want) > 30


def test_numbers_and_signatures():
    assert ocr.numbers("xiv") == [("r", 14)] and ("a", 12) in ocr.numbers("l2") and ocr.numbers("the") == []
    assert ocr.signature("C O N T E N T S") == ocr.signature("Contcnts") == ocr.signature("CONTENTS")
    assert ocr.signature("Chapter 2 Norms") == ocr.signature("Chaptcr 2 Norrns")


def test_queries_are_registered():
    names = queries()
    for n, q in ((2, "found"), (3, "found"), (4, "found"), (5, "found"), (6, "found"), (7, "ids"), (9, "found")):
        assert f"p{n}_{q}" in names
    assert set(oracle_sql()) <= set(names)
