"""Splitting and shared spans against brute force."""

import random
from collections import defaultdict

import pytest

from quire.llm import spans, splitting

CH = "book string, chapter int, title string, start_page int, end_page int, loaded_at string, page_no int"
SE = "book string, chapter int, section_no int, title string, page_no int"


def test_page_pieces(spark):
    chapters = [("b", 1, "t", 1, 20, "1", 9), ("b", 1, "t", 3, 20, "2", 9), ("b", 2, None, 5, 10, "1", 9), ("b", 3, "t", 9, 2, "1", 9), ("b", 4, "t", None, 40, "1", 9), ("b", 5, "t", 1, 40, "1", 9), ("b", 5, "t", None, 40, "2", 9), (None, 6, "t", 1, 40, "1", 9), ("b", 7, "t", 1, 7, "1", 9)]
    sections = [("b", 1, 1, "x", 3), ("b", 1, 2, "x", 7), ("b", 1, 2, "x", 7), ("b", 1, 3, "x", 6), ("b", 1, 4, "x", None), ("b", 1, 5, "x", 900), ("b", 1, 6, "x", 7 + 1)]
    c, s = spark.createDataFrame(chapters, CH), spark.createDataFrame(sections, SE)
    got = sorted((r.chapter, r.piece_start, r.piece_end) for r in splitting.page_pieces(c, s).collect())
    # from 3 the last break in reach is 7 (a section begins on 8); then no break: full pieces that share a page
    assert got == [(1, 3, 7), (1, 7, 12), (1, 12, 17), (1, 17, 20), (7, 1, 6), (7, 6, 7)]
    assert splitting.page_pieces(c.limit(0), s.limit(0)).count() == 0


def test_cut_range_properties():
    random.seed(1)
    for _ in range(500):
        a, n = random.randrange(1, 50), random.randrange(1, 60)
        breaks = {random.randrange(a, a + n) for _ in range(random.randrange(0, 12))}
        out = splitting.cut_range(a, a + n - 1, breaks)
        assert out[0][0] == a and out[-1][1] == a + n - 1
        assert all(x[1] == y[0] for x, y in zip(out, out[1:])) and all(e - s + 1 <= 6 for s, e in out)
        for s, e in out[:-1]:
            reach = [p for p in range(s + 1, s + 6) if p in breaks]
            assert e == (max(reach) if reach else s + 5)


@pytest.mark.parametrize("limit,overlap", [(80, 0), (80, 10), (50, 20), (7, 3)])
def test_text_pieces_cover_and_overlap(limit, overlap):
    random.seed(2)
    texts = ["", "short", "x" * 500, "word " * 100, "A sentence here. " * 30, "para one.\n\n" * 20 + "# Head\nbody " * 30, "\n" * 200, "é🙂" * 150]
    texts += ["".join(random.choice("ab .\n") for _ in range(400)) for _ in range(20)]
    for t in texts:
        out = splitting.cut_text(t, limit, overlap)
        assert out[0][0] == 0 and out[-1][1] == len(t)
        for (a, b, _), (c, d, o) in zip(out, out[1:]):
            assert c == b - o and 0 <= o <= overlap and d > b and c > a
        assert all(b - a <= limit for a, b, _ in out)


def test_text_pieces_prefer_natural_boundaries(spark):
    text = "First sentence is here. Second one follows it. Third closes the row."
    got = [text[a:b] for a, b, _ in splitting.cut_text(text, 50, 0)]
    assert got == ["First sentence is here. Second one follows it.", " Third closes the row."]
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, " \n")], "doc_id long, text string").selectExpr("*", "0 as piece_no")
    assert [r.doc_id for r in splitting.text_pieces(df).collect()] == [1]
    with pytest.raises(ValueError):
        splitting.text_pieces(df, limit=5, overlap=5)


# --- shared spans --------------------------------------------------------------------------------------------------------
FILES = "file_id long, loaded_at int, content string, cls string"


def brute(texts, span=200):
    grams = defaultdict(set)
    for k, t in texts.items():
        for i in range(len(t) - span + 1):
            grams[t[i : i + span]].add(k)
    pairs, covered = set(), defaultdict(set)
    for g in grams.values():
        pairs |= {(a, b) for a in g for b in g if a < b}
    for k, t in texts.items():
        for i in range(len(t) - span + 1):
            if len(grams[t[i : i + span]]) > 1:
                covered[k] |= set(range(i, i + span))
    return pairs, {k: len(v) for k, v in covered.items()}


def corpus(seed, n=60):
    random.seed(seed)
    text = lambda m, abc="abcdefgh  \n": "".join(random.choice(abc) for _ in range(m))
    shared = [text(400), text(260), text(200), "ab" * 160, " " * 150 + text(120), "é🙂" * 120]
    out = {}
    for k in range(n):
        parts = [text(random.randrange(0, 90), random.choice(["ab", "abcdefgh \n"]))]
        for _ in range(random.randrange(0, 3)):
            s = random.choice(shared)
            m = random.choice([len(s), 200, 199, 205])
            i = random.randrange(0, max(1, len(s) - m + 1))
            parts += [s[i : i + m], text(random.randrange(0, 60))]
        out[k] = "".join(parts)
    out[n], out[n + 1] = out[3] + "x" * 200, out[3] + "x" * 200  # copies
    return out


@pytest.mark.parametrize("seed,group", [(1, 64), (2, 64), (3, 3)])
def test_pairs_and_portions_equal_brute_force(spark, monkeypatch, seed, group):
    """A small group bound sends the shared texts through the exact substrings of large groups."""
    monkeypatch.setattr(spans, "GROUP", group)
    texts = corpus(seed)
    rows = [(k, 1, t, "x") for k, t in texts.items()] + [(5, 0, texts[6], "old"), (7, 1, texts[7], "again"), (900, 1, None, "x"), (901, 1, "", "x"), (902, 1, "short", "x")]
    shared = spans.Shared(spark.createDataFrame(rows, FILES))
    pairs, covered = brute(texts)
    assert {(r.a, r.b) for r in shared.pairs().collect()} == pairs and len(pairs) > 50
    got = {r.file_id: r.shared_chars for r in shared.portions().collect()}
    assert {k: v for k, v in got.items() if v} == covered and got[900] == 0
    # the linear form says the same
    groups = defaultdict(set)
    for r in shared.members().collect():
        groups[r.group_id].add(r.file_id)
    assert {(a, b) for g in groups.values() for a in g for b in g if a < b} == pairs


def test_superseded_content_is_nowhere(spark):
    random.seed(9)
    a, b = ("".join(random.choice("abcdefgh ") for _ in range(600)) for _ in range(2))
    rows = [(1, 0, a[:400], "x"), (1, 1, a, "x"), (2, 0, b, "x"), (2, 1, "other " * 40, "x"), (3, 1, b, "x")]
    shared = spans.Shared(spark.createDataFrame(rows, FILES))
    assert shared.pairs().count() == 0
    assert {r.file_id: (r.n_chars, r.shared_chars) for r in shared.portions().collect()} == {1: (600, 0), 2: (240, 0), 3: (600, 0)}


@pytest.mark.parametrize("group", [64, 1])
def test_texts_that_polynomials_of_machine_words_confuse(spark, monkeypatch, group):
    """A text of 1,024 characters after the sequence of bit parities and its complement have one name modulo 2**64."""
    monkeypatch.setattr(spans, "GROUP", group)
    bits = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = "".join("ab"[x] for x in bits), "".join("ba"[x] for x in bits)
    p = spans.Parsed([a, b])
    assert p.name(p.begins[:1], p.begins[1:2]) == p.name(p.begins[1:2], p.begins[2:3])
    one, two = (spans.Windows.names(t, spans.np.array([0]), 1024) for t in (a, b))
    assert one != two
    df = spark.createDataFrame([(1, 1, a, "x"), (2, 1, b, "x"), (3, 1, "(" + a, "x")], FILES)
    assert sorted(map(tuple, spans.Shared(df, 1024).pairs().collect())) == [(1, 3)]
    assert {r.file_id: r.shared_chars for r in spans.Shared(df, 1024).portions().collect()} == {1: 1024, 2: 0, 3: 1024}


def test_header_of_many_files_is_one_group(spark):
    random.seed(10)
    text = lambda m: "".join(random.choice("abcdefghijklm  \n") for _ in range(m))
    head, n = text(1000), 2500
    rows = [(k, 1, head + text(250), "x") for k in range(n)]
    shared = spans.Shared(spark.createDataFrame(rows, FILES))
    groups = shared.members().groupBy("group_id").count().collect()
    # and smaller ones of the files whose own text happens to begin alike
    assert max(r["count"] for r in groups) == n and len(groups) < n / 2
    assert shared.pairs().count() == n * (n - 1) // 2
    assert {r.shared_chars for r in shared.portions().select("shared_chars").distinct().collect()} <= set(range(1000, 1010))


def cut_rules(seed, n, left, right, sign="="):
    """Pairs of texts that share barely 200 characters, cut inside runs of the lengths at the ends (0: no run there)."""
    random.seed(seed)
    text = lambda m: "".join(random.choice("abcdefgh  \n") for _ in range(m))
    out = {}
    for k in range(n):
        inner = text(200 - left - right)
        longer = random.randrange(1, 20)
        out[2 * k] = text(90) + "(" + sign * left + inner + sign * right + ")" + text(90)
        out[2 * k + 1] = text(90) + "[" + sign * (left + longer if left else 0) + inner + sign * (right + longer if right else 0) + "]" + text(90)
    return out


@pytest.mark.parametrize("left,right", [(60, 60), (63, 63), (40, 40), (24, 24), (60, 0), (0, 60), (24, 63)])
def test_spans_cut_inside_runs_have_a_common_symbol(left, right):
    texts = cut_rules(left + right, 300, left, right)
    missed = 0
    for k in range(0, len(texts), 2):
        names, owners, at = spans.Parsed([texts[k], texts[k + 1]]).high()
        one, two = ({int(x): int(p) for x, o, p in zip(names, owners, at) if o == side} for side in (0, 1))
        missed += not any(spans._matches(texts[k], texts[k + 1], [(one[x], two[x])], 200) for x in one.keys() & two.keys())
    assert missed == 0


def test_spans_cut_inside_runs_equal_brute_force(spark):
    texts = dict(enumerate([*cut_rules(1, 20, 60, 60).values(), *cut_rules(2, 20, 40, 40, "-").values(), *cut_rules(3, 10, 0, 60).values()]))
    shared = spans.Shared(spark.createDataFrame([(k, 1, t, "x") for k, t in texts.items()], FILES))
    pairs, covered = brute(texts)
    assert {(r.a, r.b) for r in shared.pairs().collect()} == pairs and len(pairs) == 50
    assert {r.file_id: r.shared_chars for r in shared.portions().collect() if r.shared_chars} == covered


def test_parse_is_local():
    """Equal substrings get equal symbols but for a few at their ends."""
    random.seed(5)
    s = "".join(random.choice("abcdefghij ") for _ in range(600))
    a, b = spans.Parsed(["Q" * 7 + s]), spans.Parsed(["zyxw" * 9 + s + "tail"])
    inner = lambda p, off: {int(x) - off for x in p.start if 30 <= int(x) - off < 570}
    assert inner(a, 7) == inner(b, 36)


def test_spans_refuse_shorter_lengths(spark):
    with pytest.raises(ValueError):
        spans.Shared(spark.createDataFrame([], FILES), 50)


def test_empty(spark):
    shared = spans.Shared(spark.createDataFrame([], FILES))
    assert shared.pairs().count() == shared.portions().count() == 0
