"""Contents, configurations, identity, figures, results, readers and writers."""

import json

from pyspark.sql import functions as F

from quire.functions.text import plain_name, slug, utf8_text
from quire.operators import figures, identity, progress, results, toc
from quire.sources import readers, writers


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"x {kind}").select(expr(F.col("x"))).first()[0]


def test_slug_and_names(spark):
    assert one(spark, "Real  Analysis: A Course with Notes, 2nd!", "string", slug) == "real_analysis_a_course"
    assert len(one(spark, "ab " * 60, "string", slug)) == 50
    for name, ok in (("a", True), ("", False), ("a/b", False), ("a\\b", False), ("..", False), (None, False)):
        assert one(spark, name, "string", plain_name) is ok


def test_utf8(spark):
    assert one(spark, bytearray(b"a\xff\r\nb\rc"), "binary", utf8_text) == "a\ufffd\nb\nc"


def test_contents_first_pattern_wins(spark):
    text = "Chapter 1 Title words ... 17\n2 Another one .... 30\nChapter 2 Aardvark here ... 40\nChapter 31 Too many of them ... 50\nChapter 3 Beyond the end ... 999"
    got = toc.chapter_ranges(spark.createDataFrame([("b", text, 100)], "book string, text string, n_pages int")).orderBy("chapter").collect()
    assert [(r.chapter, r.title, r.start_page, r.end_page) for r in got] == [(1, "Title words", 17, 39), (2, "Aardvark here", 40, 99)]
    got = toc.chapter_ranges(spark.createDataFrame([("b", None, 3), ("c", "", 3)], "book string, text string, n_pages int"))
    assert got.count() == 0


def test_chunks_and_overlaps(spark):
    r = spark.createDataFrame([(1, 3, 15), (2, 15, 15), (3, 20, 10), (4, None, 4), (5, 100, 400)], "id int, s int, e int").withColumn("k", F.lit("x"))
    assert [(x.chunk_start, x.chunk_end) for x in toc.page_chunks(r, ["id"], "s", "e").where("id = 1").orderBy("chunk_start").collect()] == [(3, 8), (9, 14), (15, 15)]
    assert sorted((x.a, x.b) for x in toc.overlaps(r, "k", "id", "s", "e").collect()) == [(1, 2)]


def test_split_files(spark):
    t = spark.createDataFrame([(1, "intro\n%%% FILE: sec01_1.tex %%%\n A \n%%%FILE: sec01_2.tex%%%"), (2, "only"), (3, None)], "chapter int, t string")
    got = [(r.chapter, r.filename, r.content) for r in toc.split_files(t, ["chapter"], "t", "chapter").orderBy("chapter", "ord").collect()]
    assert got == [(1, "sec01_1.tex", "A\n"), (1, "sec01_2.tex", "\n"), (2, "sec02_1.tex", "only\n")]


def test_page_text(spark):
    p = spark.createDataFrame([("a", 2, "two"), ("a", 1, None), ("a", 30, "x")], "pdf string, n int, t string")
    assert toc.page_text(p, "pdf", "n", "t", first=20).first().text == "--- Page 1 ---\n\n\n--- Page 2 ---\ntwo"
    assert one(spark, "\n  \n Title \nx", "string", toc.first_line) == "Title" and one(spark, "", "string", toc.first_line) is None


def test_config_text(spark):
    text = "# C=1\nA = \"x y\"\nB='q'\n C=bare\nA=2\nlower=3\nD=\nE=\"open\nCH01_PAGES=\"3-9\"\nCH2_PAGES=\"1-x\""
    got = {r.key: r.value for r in identity.parsed_configs(spark.createDataFrame([(1, text), (2, None)], "id int, content string"), ["id"]).collect()}
    assert got == {"A": "2", "B": "q", "C": "bare", "D": "", "E": '"open', "CH01_PAGES": "3-9", "CH2_PAGES": "1-x"}
    r = one(spark, text, "string", identity.config_ranges)
    assert [(x.chapter, x.start_page, x.end_page) for x in r] == [(1, 3, 9)]


GOOD = {"PAGE_COUNT": "341", "PAGE_OFFSET": "12", "COPYRIGHT_PAGE": "4", "FIGURE_NUMBERING": "two-part", "BACKMATTER_PAGES": "320-341", "CH01_PAGES": "17-42"}


def reasons(spark, conf, pages=341):
    df = spark.createDataFrame([(conf, pages)], "conf map<string,string>, pages int")
    return df.select(identity.reasons(F.col("conf"), F.col("pages"))).first()[0]


def test_identity_reasons(spark):
    assert reasons(spark, GOOD) == []
    assert reasons(spark, GOOD, 175) == ["different_book:341<>175"]
    assert reasons(spark, {k: v for k, v in GOOD.items() if k != "PAGE_COUNT"}) == ["no_page_count"]
    assert reasons(spark, GOOD | {"PAGE_COUNT": "about 3"}) == ["page_count_not_integer:about 3"]
    for k in identity.REQUIRED_KEYS:
        assert reasons(spark, GOOD | {k: " "}) == [f"missing:{k}"]
    assert reasons(spark, {k: v for k, v in GOOD.items() if k != "CH01_PAGES"}) == ["missing:CHNN_PAGES"]
    assert reasons(spark, None)[0] == "no_page_count"


def test_decisions(spark):
    confs = spark.createDataFrame([("a", "./p/x.pdf", True), ("b", "p\\x.pdf", False), ("c", "p/y.pdf", True), ("d", "p/y.pdf", True), ("e", None, True)], "book string, source_pdf string, ok boolean")
    pdfs = spark.createDataFrame([("p/x.pdf",), ("p/y.pdf",), ("p/z.pdf",)], "pdf string")
    got = {r.pdf: (r.decision, r.book) for r in identity.decisions(pdfs, identity.claimants(confs, pdfs)).collect()}
    assert got == {"p/x.pdf": ("RESUME", "a"), "p/y.pdf": ("STOP", None), "p/z.pdf": ("FRESH", None)}


def test_captions(spark):
    t = spark.createDataFrame([("Figure 3.7, Figure 3.7.1, Figure 3.12.1, figure I-3 Figure II–15a Figure V-1",), (None,)], "t string")
    ids = lambda s: [(r.chapter, r.fig_id) for r in figures.captions(t, "t", s).orderBy("ord").collect()]
    assert ids("two-part") == [(3, "3.7"), (3, "3.1")]
    assert ids("two-part-strict") == [(3, "3.7")]
    assert ids("three-part") == [(3, "3.7.1"), (3, "3.12.1")]
    assert ids("roman") == [(1, "I-3"), (2, "II-15a")]


def test_first_caption(spark):
    for text, style, expected in (("see figure 3.12.1", "two-part", "3.1"), ("x", "two-part", None), ("figure ii–15a", "roman", "II-15a"), ("Figure 1.2.3 Figure 4.5.6", "three-part", "1.2.3"), (None, "roman", None)):
        assert one(spark, text, "string", lambda c, s=style: figures.first_caption(c, s)) == expected
    boxes = spark.createDataFrame([("Figure 2.3", [[0.0, 150.0], [1.0, 150.0]]), ("none", [[0.0, 1.0]])], "text string, bbox array<array<double>>")
    assert [(r.fig_id, r.caption_y) for r in figures.captions_in_boxes(boxes, "two-part").collect()] == [("2.3", 72.0)]


def test_progress(spark):
    text = "# Phase 1\n- [x] a\n- [ ] b\n* [X] c \n## Two\n- [x]d\n- [ ] e\n| A | B |\n|---|:-:|\n| 1 |  |"
    df = spark.createDataFrame([("k", text), ("n", None)], "book string, text string")
    got = [(r.line_no, r.section, r.item, r.done) for r in progress.check_list(df, ["book"], "text").orderBy("line_no").collect()]
    assert got == [(2, "Phase 1", "a", True), (3, "Phase 1", "b", False), (4, "Phase 1", "c", True), (6, "Two", "d", True), (7, "Two", "e", False)]
    assert [r.cells for r in progress.table_rows(df, ["book"], "text").orderBy("line_no").collect()] == [["A", "B"], ["1", ""]]
    total = progress.roll_up(progress.check_list(df, ["book"], "text"), ["section"]).where("level = 0").first()
    assert (total["items"], total.done, total.share) == (5, 3, 0.6)


def test_repair_until_stable(spark):
    from quire.plans import repair

    files = spark.createDataFrame([(1, "x^2^3 \\bold{y}"), (2, "plain"), (3, None)], "id int, content string")
    out = repair.until_stable(files)
    assert (out.rounds, out.fixes, out.reason) == (2, 2, "stable")
    assert {r.id: r.content for r in out.files.collect()} == {1: "x^{2^{3}} \\mathbf{y}", 2: "plain", 3: None}
    bad = lambda f: f.where("content like '%bold%'")
    assert repair.until_stable(files, bad).reason == "clean"
    assert repair.until_stable(files, max_rounds=1).reason == "limit"


def test_runs_without_a_log_and_preference(spark):
    from quire.operators import logs

    lines = spark.createDataFrame([(1, 0, "./a.tex:3: Bad")], "log_id int, line_no int, line string")
    runs = spark.createDataFrame([(1,), (2,), (2,)], "log_id int")
    assert sorted((r.log_id, r.message) for r in logs.errors_of_all(runs, lines).collect()) == [(1, "Bad"), (2, "no log was written")]
    files = spark.createDataFrame([("b", "docs/p.md"), ("b", "p.md"), ("c", "docs/p.md"), ("d", "x")], "book string, rel_path string")
    assert {r.book: r.rel_path for r in results.first_present(files, ["book"], ["p.md", "docs/p.md"]).collect()} == {"b": "p.md", "c": "docs/p.md"}
    assert results.selected(spark.createDataFrame([("a",), ("b",)], "suite string"), "a").count() == 1


def test_geometry(spark):
    blocks = [(0.0, 100.0, "x" * 60), (0.0, 200.0, "Figure " + "x" * 60), (0.0, 300.0, "short")]
    df = spark.createDataFrame([(blocks, 400.0), ([], 60.0)], "blocks array<struct<y0:double,y1:double,text:string>>, y double")
    got = [tuple(r) for r in df.select(figures.crop_by_text(F.col("blocks"), F.col("y"), F.lit(600.0), F.lit(800.0))["y0"], figures.crop_by_nearest(F.col("blocks"), F.col("y"), F.col("y") + 10, F.lit(600.0))["y0"], figures.crop_above(F.col("y"), F.col("y") + 10, F.lit(600.0))["y0"]).collect()]
    assert got == [(105.0, 205.0, 200.0), (30.0, 30.0, 0.0)]


def test_nearest_above(spark):
    caps = spark.createDataFrame([(1, 100.0, "a"), (1, 300.0, "b"), (2, 50.0, "c")], "page int, y double, other string")
    blocks = spark.createDataFrame([(1, 90.0), (1, 91.0), (1, 250.0), (1, 500.0), (1, None)], "page int, y1 double")
    got = {r.other: r.nearest_bottom for r in figures.nearest_above(caps, blocks, ["page"], "y", "y1", 10).collect()}
    assert got == {"a": None, "b": 250.0, "c": None}


def test_paths_by_place_and_reconcile(spark):
    env = lambda n, img: f"\\begin{{figure}}\\includegraphics[x]{{{img}}}\\caption{{c}}\\label{{fig:{n}}}\\end{{figure}}"
    f = spark.createDataFrame([("b", env("1.2.3", "placeholder.png") + " mid " + env("1.2.4", "placeholder.png")), ("c", "none"), ("b", None)], "book string, content string").selectExpr("*", "hash(book, content) as file_id", "'x' as path")
    # of two paths of one figure the least counts
    figs = spark.createDataFrame([("b", "1.2.4", "figures/ch01/fig_1_2_4.png"), ("b", "1.2.4", "figures/ch02/other.png"), (None, None, None)], "book string, fig_id string, path string")
    got = {r.book + str(r.changed): r.content for r in figures.rewritten_paths(f, figs, ["book"]).collect()}
    assert got["bTrue"] == env("1.2.3", "placeholder.png") + " mid " + env("1.2.4", "figures/ch01/fig_1_2_4.png").replace("[x]", "[width=0.8\\textwidth]")
    assert got["cFalse"] == "none" and got["bFalse"] is None
    sides = {r.fig: r.side for r in figures.reconciled(spark.createDataFrame([("1",), ("2",)], "fig string"), spark.createDataFrame([("2",), ("3",)], "fig string"), ["fig"]).collect()}
    assert sides == {"1": "only_left", "2": "both", "3": "only_right"}


def test_located_retry(spark):
    wanted = spark.createDataFrame([(1, "Figure I-3", "Figure I–3"), (1, "Figure II-1", "Figure II–1")], "page int, t string, r string")
    spans = spark.createDataFrame([(1, "Figure I–3", 1, 5.0), (1, "Figure I–3", 0, 9.0)], "page int, span_text string, ord int, x0 double").withColumns({c: F.col("x0") for c in ("y0", "x1", "y1")})
    got = {r.t: r.rect for r in figures.located(wanted, spans, ["page"], "t", "r").collect()}
    assert got["Figure I-3"].x0 == 9.0 and got["Figure II-1"] is None


def test_results(spark):
    rows = [(1, "a", "m", "success", 10, 5, None), (1, "a", "m", "success", 10, 5, None), (2, "a", "m", "BLOCKED ", None, 7, None), (3, None, "m", "error", 0, None, None)]
    df = spark.createDataFrame(rows, "result_id int, suite string, model string, status string, output_length int, latency_ms int, loaded_at timestamp")
    total = results.summary(df, ["suite", "model"]).where("level = 0").first()
    assert (total.tests, total.success, total.blocked, total.other, total.output_chars, total.mean_latency_ms) == (3, 1, 1, 1, 10, 6.0)
    for text, kind in (("Output blocked by x", "blocked"), ("429", "retry"), ("overloaded", "retry"), ("odd", "error"), ("", None), (None, None)):
        assert one(spark, text, "string", results.error_class) == kind
    assert one(spark, "no_metadata", "string", results.holds_metadata) is True  # by its name alone


def test_readers_and_writers(spark, tmp_path):
    root = tmp_path / "books"
    for rel, data in {"b1/latex/preamble.tex": b"p", "b1/latex/ch01/sec01_1.tex": b"% PAGES: 3\r\nx\xff", "b1/latex/ch10/sec10_1.TEX": b"y", "b1/latex/backmatter/a.tex": b"z", "b1/book.conf": b'CH01_PAGES="3-9"\nK=v\n', "b1/x.png": b"\x89"}.items():
        p = root / rel
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    tree = readers.read_tree(spark, str(root))
    got = {r.rel_path: (r.book, r.chapter, r.stem, r.ordinal, r.content) for r in tree.collect()}
    assert got["latex/ch01/sec01_1.tex"] == ("b1", 1, "sec01_1", 1, "% PAGES: 3\nx\ufffd")
    assert got["latex/preamble.tex"][3] == 0 and got["latex/backmatter/a.tex"][3] == 2 and len(got) == 3
    assert [r.chapter for r in readers.chapters(tree).collect()] == [1]
    assert readers.source_files(tree, 1).count() == 1 and readers.sections(tree, strict=True).count() == 1
    assert {r.key: r.value for r in readers.read_configs(spark, str(root)).collect()} == {"CH01_PAGES": "3-9", "K": "v"}
    assert readers.read_config_ranges(spark, str(root)).first().end_page == 9
    (tmp_path / "r.json").write_text(json.dumps([{"test_name": "t", "num_pages": 3, "includes_metadata": True}]))
    assert readers.read_results(spark, str(tmp_path / "r.json")).first().num_pages == 3
    (tmp_path / "l.log").write_text("! E\r\nl.3 x")
    assert readers.read_logs(spark, str(tmp_path / "l.log")).count() == 2
    pages = spark.createDataFrame([("a", " "), ("a", None), ("b", " x ")], "pdf string, text string")
    assert {r.pdf: r.needs_ocr for r in readers.text_layer(pages.select("pdf", readers.page_chars(F.col("text")).alias("chars"))).collect()} == {"a": True, "b": False}
    changed = writers.changed_only(spark.createDataFrame([(1, "a", "a"), (2, "a", "b"), (3, None, None)], "i int, o string, n string"), "o", "n")
    assert [r.i for r in changed.collect()] == [2]
    assert one(spark, 612.0, "double", lambda c: writers.page_geometry(c, F.lit(792.0))) == "\\geometry{paperwidth=8.50in,paperheight=11.00in}"
    w = writers.wrapper_text(spark.createDataFrame([("b", 1, "sec01_10", 5), ("b", 1, "sec01_2", 5), ("b", 1, "sec01_3", 2)], "book string, chapter int, stem string, first_page int"), spark.createDataFrame([("b", 1, "T")], "book string, chapter int, title string")).first().text
    assert w == "\\chapter{T}\n\\label{ch:1}\n\n\\input{ch01/sec01_3}\n\\input{ch01/sec01_2}\n\\input{ch01/sec01_10}\n"
    assert "\\include{ch03/ch03}" in writers.main_text(spark.createDataFrame([("b", 3)], "book string, chapter int")).first().text
    writers.write_texts(spark.createDataFrame([("b", "t1")], "book string, text string"), str(tmp_path / "out"), ["book"])
    assert spark.read.text(str(tmp_path / "out")).count() == 1


def test_stream_runs_what_is_there(spark, tmp_path):
    from quire.streaming import rules

    d = tmp_path / "in" / "b" / "latex" / "ch01"
    d.mkdir(parents=True)
    (d / "sec01_1.tex").write_text("x^2^3 \\bold{y}")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    for n, name in ((1, "sec01_2.tex"), (2, "sec01_3.tex")):
        rules.run_available(rules.repaired(rules.arriving(spark, str(tmp_path / "in"))).select("rel_path", "content", "total_fixes"), out, ck).awaitTermination()
        assert spark.read.parquet(out).count() == n
        (d / name).write_text("plain")
    assert spark.read.parquet(out).where("total_fixes = 2").first().content == "x^{2^{3}} \\mathbf{y}"
