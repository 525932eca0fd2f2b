"""The same results in DuckDB's SQL, written on their own."""

from __future__ import annotations

_P1_HELD = r"""
WITH latest AS (
    SELECT book, revision, committed_at, conf FROM book_conf WHERE revision IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY book, revision ORDER BY loaded_at DESC NULLS LAST, committed_at DESC NULLS LAST) = 1
), pairs AS (
    SELECT book, revision, unnest(map_keys(conf)) AS key, unnest(map_values(conf)) AS val FROM latest
), named AS (
    SELECT book, revision, key, nullif(trim(val, ' "''' || chr(9) || chr(10) || chr(160)), '') AS v,
           CASE
               WHEN lower(key) IN ('page_count', 'pagecount', 'n_pages', 'num_pages', 'total_pages', 'pdf_pages') THEN 'PAGE_COUNT'
               WHEN lower(key) IN ('figure_numbering', 'figurenumbering', 'fig_numbering', 'caption_numbering', 'figure_style') THEN 'FIGURE_NUMBERING'
               WHEN lower(key) IN ('backmatter_pages', 'backmatter-pages', 'back_pages', 'backmatter_range', 'endmatter_pages') THEN 'BACKMATTER_PAGES'
           END AS field
    FROM pairs
), held AS (
    SELECT book, revision, field, key, v,
           CASE WHEN regexp_full_match(v, '[0-9]+') THEN 'integer'
                WHEN regexp_full_match(v, '[0-9]+\.[0-9]+') THEN 'decimal'
                WHEN v IN ('true', 'false') THEN 'boolean'
                WHEN regexp_full_match(v, '[0-9]+ *[-–—]+ *[0-9]+') THEN 'range'
                WHEN regexp_full_match(v, '\[?[0-9]+( *, *[0-9]+)+\]?') THEN 'list'
                ELSE 'text' END AS type
    FROM named WHERE field IS NOT NULL AND v IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY book, revision, field ORDER BY key <> field, key) = 1
)
"""

SQL = {
    "p1_found": _P1_HELD
    + """, revs AS (SELECT book, revision, lag(revision) OVER (PARTITION BY book ORDER BY revision) AS before FROM latest),
    fields AS (SELECT unnest(['PAGE_COUNT', 'FIGURE_NUMBERING', 'BACKMATTER_PAGES']) AS field),
    both_sides AS (
        SELECT r.book, r.revision, f.field, o.key AS ok, o.type AS ot, n.key AS nk, n.type AS nt
        FROM revs r CROSS JOIN fields f
        LEFT JOIN held o ON o.book = r.book AND o.revision = r.before AND o.field = f.field
        LEFT JOIN held n ON n.book = r.book AND n.revision = r.revision AND n.field = f.field
        WHERE r.before IS NOT NULL
    )
    SELECT book, revision, field, 'added' AS change FROM both_sides WHERE ok IS NULL AND nk IS NOT NULL
    UNION ALL SELECT book, revision, field, 'removed' FROM both_sides WHERE ok IS NOT NULL AND nk IS NULL
    UNION ALL SELECT book, revision, field, 'renamed' FROM both_sides WHERE ok <> nk
    UNION ALL SELECT book, revision, field, 'retyped' FROM both_sides WHERE ot <> nt""",
    "p1_schema": _P1_HELD
    + """SELECT field, key, type, count(*) AS revisions, count(DISTINCT book) AS books, min(revision) AS first_revision, max(revision) AS last_revision
    FROM held GROUP BY field, key, type""",
}

_FILES = """files AS (
    SELECT * FROM source_file QUALIFY row_number() OVER (PARTITION BY file_id ORDER BY loaded_at DESC NULLS LAST) = 1
)"""
_TEX = f"WITH {_FILES}, tex AS (SELECT * FROM files WHERE suffix = 'tex')"
_RANGES = """ranges AS (
    SELECT * FROM chapter_range WHERE book IS NOT NULL AND chapter IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY book, chapter ORDER BY loaded_at DESC NULLS LAST, title DESC NULLS LAST, start_page DESC NULLS LAST, end_page DESC NULLS LAST) = 1
)"""
_PAGES = """pages AS (
    SELECT * FROM ocr_page QUALIFY row_number() OVER (PARTITION BY ocr_id ORDER BY loaded_at DESC NULLS LAST) = 1
)"""
_N = lambda pattern, col="content": rf"coalesce(len(regexp_extract_all({col}, '{pattern}')), 0)"

SQL["p1_table"] = (
    _P1_HELD
    + ", wide AS (SELECT l.book, l.revision, l.committed_at, "
    + ", ".join(f"max(h.key) FILTER (h.field = '{f}') AS {f.lower()}_key, max(h.type) FILTER (h.field = '{f}') AS {f.lower()}_type, max(h.v) FILTER (h.field = '{f}') AS {f.lower()}_v" for f in ("PAGE_COUNT", "FIGURE_NUMBERING", "BACKMATTER_PAGES"))
    + " FROM latest l LEFT JOIN held h ON h.book IS NOT DISTINCT FROM l.book AND h.revision = l.revision GROUP BY ALL) SELECT book, revision, committed_at, "
    + ", ".join(
        rf"""{f}_key, {f}_type,
        CASE WHEN {f}_type = 'integer' THEN try_cast({f}_v AS INTEGER) END AS {f}_integer,
        CASE WHEN {f}_type = 'decimal' THEN try_cast({f}_v AS DOUBLE) END AS {f}_decimal,
        CASE WHEN {f}_type = 'boolean' THEN {f}_v = 'true' END AS {f}_boolean,
        CASE WHEN {f}_type = 'range' THEN array_to_string(list_transform(regexp_extract_all({f}_v, '[0-9]+'), lambda x: CAST(try_cast(x AS INTEGER) AS VARCHAR)), '-') END AS {f}_range,
        CASE WHEN {f}_type = 'list' THEN array_to_string(list_transform(regexp_extract_all({f}_v, '[0-9]+'), lambda x: CAST(try_cast(x AS INTEGER) AS VARCHAR)), ',') END AS {f}_list,
        CASE WHEN {f}_type = 'text' THEN {f}_v END AS {f}_text"""
        for f in ("page_count", "figure_numbering", "backmatter_pages")
    )
    + r""", try_cast(regexp_extract(page_count_v, '[0-9]+') AS INTEGER) AS page_count,
    CASE figure_numbering_v WHEN '0' THEN 'none' WHEN 'false' THEN 'none' WHEN '1' THEN 'one-part' WHEN '2' THEN 'two-part' WHEN 'true' THEN 'two-part' WHEN '3' THEN 'three-part' ELSE figure_numbering_v END AS figure_numbering,
    list_min(list_transform(regexp_extract_all(backmatter_pages_v, '[0-9]+'), lambda x: try_cast(x AS INTEGER))) AS backmatter_first,
    list_max(list_transform(regexp_extract_all(backmatter_pages_v, '[0-9]+'), lambda x: try_cast(x AS INTEGER))) AS backmatter_last
    FROM wide"""
)

SQL["element_inventory"] = (
    _TEX
    + rf""", counts AS (
    SELECT book, chapter, {_N(r"\\section\{")} AS sections, {_N(r"\\begin\{(?:equation|align|gather|multline)\*?\}")} AS equations,
           {_N(r"\\begin\{figure\}")} AS figures, {_N(r"\\item")} AS exercises FROM tex WHERE chapter IS NOT NULL)
    SELECT book, chapter, CAST(sum(sections) AS BIGINT) AS sections, CAST(sum(equations) AS BIGINT) AS equations, CAST(sum(figures) AS BIGINT) AS figures,
           CAST(sum(exercises) AS BIGINT) AS exercises, 2 - grouping(book) - grouping(chapter) AS level FROM counts GROUP BY ROLLUP (book, chapter)"""
)
SQL["figure_total"] = _TEX + rf""" SELECT CAST(sum({_N(r"\\begin\{figure\}")}) AS BIGINT) AS figures,
    CAST(sum({_N(r"\\item")} - {_N(r"\\item[A-Za-z]")}) AS BIGINT) AS strict_items FROM tex"""
_GREEK = (
    r"\\(?:alpha|beta|gamma|delta|epsilon|varepsilon|zeta|eta|theta|vartheta|iota|kappa|lambda|mu|nu|xi|rho|varrho|sigma|varsigma|tau|upsilon|phi|varphi"
    r"|chi|psi|omega|Gamma|Delta|Theta|Lambda|Xi|Pi|Sigma|Upsilon|Phi|Psi|Omega|hat|bar|tilde|dot|ddot|bf[A-Za-z]+)\b"
)
SQL["symbol_topk"] = _TEX + rf""", terms AS (SELECT unnest(regexp_extract_all(content, '{_GREEK}')) AS term FROM tex)
    SELECT term, count(*) AS n FROM terms GROUP BY term ORDER BY n DESC, term LIMIT 40"""
SQL["subscript_topk"] = _TEX + r""", terms AS (SELECT chapter, unnest(regexp_extract_all(content, '[A-Za-z]_\{?[0-9A-Za-z]+\}?')) AS term FROM tex WHERE chapter IS NOT NULL),
    counts AS (SELECT chapter, term, count(*) AS n FROM terms GROUP BY ALL)
    SELECT chapter, term, n, CAST(row_number() OVER (PARTITION BY chapter ORDER BY n DESC, term) AS INTEGER) AS rank FROM counts QUALIFY rank <= 40"""
SQL["book_inventory"] = f"""WITH {_FILES} SELECT book, count(DISTINCT chapter) AS chapters, count(*) FILTER (suffix = 'tex') AS tex_files,
    count(*) FILTER (suffix <> 'tex') AS other_files FROM files GROUP BY book"""

# --- the rewrite chain: each rule a step of (text expression, count expression) over column c ---------------------------


def _replace(pattern: str, into: str) -> tuple[str, str]:
    return rf"regexp_replace(c, '{pattern}', '{into}', 'g')", rf"len(regexp_extract_all(c, '{pattern}'))"


def _line_rule(pattern: str, into: str) -> tuple[str, str]:
    math = r"NOT regexp_matches(x, '\\includegraphics|\\input\b|\\include\b|\\label\b|\\ref\b|\\caption\b|\\bibliography|\\url\b|\\href\b|\.png|\.pdf|\.tex') AND NOT regexp_matches(x, '^\s*%')"
    split = "string_split(c, chr(10))"
    return (
        rf"array_to_string(list_transform({split}, lambda x: CASE WHEN {math} THEN regexp_replace(x, '{pattern}', '{into}', 'g') ELSE x END), chr(10))",
        rf"coalesce(list_sum(list_transform({split}, lambda x: CASE WHEN {math} THEN len(regexp_extract_all(x, '{pattern}')) ELSE 0 END)), 0)",
    )


def _proof() -> tuple[str, str]:
    pattern = r"(?s)\\begin\{proof\}(.*?)\\end\{proof\}"
    marks = [r"\s*\\qed\b", r"\s*\\hfill\s*\$\\blacksquare\$", r"\s*\$\\blacksquare\$", r"\s*\\hfill\s*\\\(\\blacksquare\\\)"]
    text, count = "b", "0"
    for m in marks:
        count += rf" + len(regexp_extract_all({text}, '{m}'))"
        text = rf"regexp_replace({text}, '{m}', '', 'g')"
    bodies, outside = rf"regexp_extract_all(c, '{pattern}', 1)", rf"regexp_split_to_array(c, '{pattern}')"
    clean = rf"list_transform({bodies}, lambda b: '\begin{{proof}}' || {text} || '\end{{proof}}')"
    return (
        rf"array_to_string(list_transform(range(1, len({outside}) + 1), lambda i: ({outside})[i] || coalesce(({clean})[i], '')), '')",
        rf"coalesce(list_sum(list_transform({bodies}, lambda b: {count})), 0)",
    )


_RULES = [
    ("boxed_environment", [_replace(r"(?s)\\begin\{boxed\}\s*(.*?)\s*\\end\{boxed\}", r"\\boxed{\1}")]),
    ("defbox_in_math", [_replace(r"(?s)\\begin\{defbox\}\s*(.*?)\s*\\end\{defbox\}", r"\\boxed{\1}")]),
    ("double_math_boxed", [_replace(r"\\boxed\{\$([^$]+)\$\}", r"\\boxed{\1}")]),
    ("boxed_display_math", [_replace(r"(?s)\\boxed\{\\?\[\s*(.*?)\s*\\?\]\}", r"\\[\\boxed{\1}\\]")]),
    ("missing_partial", [_replace(r"\\frac\{partial\}\{partial\s+([\p{L}\p{N}_])\}", r"\\frac{\\partial}{\\partial \1}")]),
    ("duplicate_qed", [_proof()]),
    ("undefined_control", [_replace(r"\\textup\b", r"\\textrm"), _replace(r"\\bold\b", r"\\mathbf")]),
    ("double_superscript", [_line_rule(r"([\p{L}\p{N}_])\^([\p{L}\p{N}_])\^([\p{L}\p{N}_])", r"\1^{\2^{\3}}")]),
    ("double_subscript", [_line_rule(r"([\p{L}\p{N}_])_([\p{L}\p{N}_])_([\p{L}\p{N}_])", r"\1_{\2_{\3}}")]),
]


def _chain(source: str, keep: str) -> str:
    """CTEs s0, s1, ... over (keep, c): each rule's step adds its counter."""
    out = rf"""{source}, s0 AS (SELECT {keep}, replace(raw, chr(12), '') AS c, replace(raw, chr(12), '') AS c0, CAST(contains(raw, chr(12)) AS BIGINT) AS n_form_feed,
        CAST(len(regexp_extract_all(replace(raw, chr(12), ''), '\\foreach\s+\\?\w+\s+in\s*\{{[^}}]*\+[^}}]*\}}')) AS BIGINT) AS n_foreach_arithmetic FROM given)"""
    k = 0
    for name, steps in _RULES:
        for j, (text, count) in enumerate(steps):
            counter = f"CAST({count} AS BIGINT) AS n_{name}" if j == 0 else f"n_{name} + CAST({count} AS BIGINT) AS n_{name}"
            drop = "c" if j == 0 else f"c, n_{name}"
            out += f", s{k + 1} AS (SELECT * EXCLUDE ({drop}), {text} AS c, {counter} FROM s{k})"
            k += 1
    total = " + ".join(f"n_{n}" for n, _ in _RULES)
    return out + f", done AS (SELECT *, (c <> c0) OR n_form_feed > 0 AS changed, n_form_feed + CASE WHEN c <> c0 THEN {total} ELSE 0 END AS total_fixes FROM s{k})"


_DAMAGE = "content"
for _a, _b in (
    (r"\\(begin|end)\{remark\}", r"\\\1{boxed}"), (r"\\(begin|end)\{example\}", r"\\\1{defbox}"), (r"Let \$([^$]+)\$", r"Let \\boxed{$\1$}"),
    (r"(?s)\\\[\n(.*?)\n\\\]", "\\\\\\\\boxed{\\\\\\\\[\n\\\\1\n\\\\\\\\]}".replace("\\\\\\\\", "\\\\").replace("\\\\1", "\\1")), (r"\\partial_\{([a-z])\}", r"\\frac{partial}{partial \1}"),
    (r"\\end\{proof\}", "\\\\hfill$\\\\blacksquare$\n\\\\qed\n\\\\end{proof}"), (r"\\mathbb\{R\}", r"\\bold{R}"), (r"([a-z])\^\{([0-9])([0-9])\}", r"\1^\2^\3"), (r"([a-z])_\{([0-9])([0-9])\}", r"\1_\2_\3"), (r"\\sqrt", "\f\\\\sqrt"),
):
    _DAMAGE = f"regexp_replace({_DAMAGE}, '{_a}', '{_b}', 'g')"
_KEPT = ", ".join(f"n_{n}" for n, _ in _RULES)
SQL["rewrite_chain"] = _chain(f"{_TEX}, given AS (SELECT file_id, {_DAMAGE} AS raw FROM tex WHERE content IS NOT NULL)", "file_id") + f" SELECT file_id, md5(c) AS content_md5, n_form_feed, n_foreach_arithmetic, {_KEPT}, changed, total_fixes FROM done"
SQL["rewrite_as_is"] = _chain(f"{_TEX}, given AS (SELECT file_id, book, coalesce(content, '') AS raw FROM tex)", "file_id, book") + """
    SELECT book, count(*) AS files, count(*) FILTER (changed) AS changed, CAST(sum(total_fixes) AS BIGINT) AS fixes FROM done GROUP BY book"""

# --- checks -------------------------------------------------------------------------------------------------------------
_WRAPPER = _TEX + r""", f AS (SELECT * FROM tex WHERE book IS NOT NULL AND chapter IS NOT NULL AND stem IS NOT NULL),
    sections AS (SELECT DISTINCT book, chapter, stem FROM f WHERE starts_with(stem, 'sec') AND contains(rel_path, '/ch')),
    wrappers AS (SELECT book, chapter, content FROM f WHERE stem = 'ch' || lpad(CAST(chapter AS VARCHAR), 2, '0')),
    bare AS (SELECT book, chapter, array_to_string(list_transform(string_split(content, chr(10)), lambda x: regexp_replace(x, '(^|[^\\])%.*', '\1')), chr(10)) AS content FROM wrappers),
    refs AS (
        SELECT DISTINCT book, chapter, regexp_replace(regexp_extract(replace(trim(t), '\', '/'), '([^/]*)$', 1), '\.tex$', '') AS stem
        FROM (SELECT book, chapter, unnest(regexp_extract_all(content, '\\(?:input|include|subfile)\s*\{([^}]*)\}', 1)) AS t FROM bare)
    ), real_refs AS (SELECT * FROM refs WHERE stem <> ''),
    root AS (SELECT DISTINCT book, stem FROM tex WHERE NOT contains(rel_path, '/ch') AND stem IS NOT NULL),
    found AS (
        SELECT s.book, s.chapter, s.stem, 'orphan' AS code FROM sections s WHERE EXISTS (SELECT 1 FROM wrappers w WHERE w.book = s.book AND w.chapter = s.chapter)
            AND NOT EXISTS (SELECT 1 FROM real_refs r WHERE r.book = s.book AND r.chapter = s.chapter AND r.stem = s.stem)
        UNION ALL
        SELECT r.book, r.chapter, r.stem, 'dangling' FROM real_refs r WHERE starts_with(r.stem, 'sec')
            AND NOT EXISTS (SELECT 1 FROM sections s WHERE r.book = s.book AND r.chapter = s.chapter AND r.stem = s.stem)
            AND NOT EXISTS (SELECT 1 FROM root o WHERE o.book = r.book AND o.stem = r.stem)
        UNION ALL
        SELECT DISTINCT s.book, s.chapter, CAST(NULL AS VARCHAR), 'no_wrapper' FROM sections s WHERE NOT EXISTS (SELECT 1 FROM wrappers w WHERE w.book = s.book AND w.chapter = s.chapter)
        UNION ALL
        SELECT DISTINCT w.book, w.chapter, CAST(NULL AS VARCHAR), 'empty' FROM wrappers w WHERE NOT EXISTS (SELECT 1 FROM sections s WHERE w.book = s.book AND w.chapter = s.chapter)
    )"""
SQL["wrapper_integrity"] = _WRAPPER + " SELECT book, chapter, stem, code FROM found"
_LAYOUT = "SELECT b.book, r.rel_path FROM (SELECT DISTINCT book FROM source_file WHERE book IS NOT NULL) b CROSS JOIN (SELECT unnest(['book.conf', 'progress.md', 'latex/main.tex', 'latex/preamble.tex']) AS rel_path) r WHERE NOT EXISTS (SELECT 1 FROM source_file s WHERE s.book = b.book AND s.rel_path = r.rel_path)"
SQL["layout_required"] = _LAYOUT
SQL["violations"] = _WRAPPER + f""", all_ AS (SELECT 'layout' AS "check", book AS scope, 'missing' AS code FROM ({_LAYOUT}) UNION ALL SELECT 'wrapper', book, code FROM found)
    SELECT "check", code, count(*) AS n, count(DISTINCT scope) AS books FROM all_ GROUP BY ALL"""
SQL["reading_order"] = _TEX + r""", o AS (SELECT book, chapter, file_id, stem, coalesce(try_cast(nullif(regexp_extract(string_split(content, chr(10))[1], '% PAGES:\s*(\d+)', 1), '') AS INTEGER), 1000000000) AS first_page
    FROM tex WHERE stem LIKE 'sec%' AND book IS NOT NULL AND chapter IS NOT NULL)
    SELECT *, CAST(row_number() OVER (PARTITION BY book, chapter ORDER BY first_page, stem, file_id) AS INTEGER) AS position FROM o"""
SQL["env_balance"] = _TEX.replace("WITH", "WITH RECURSIVE", 1) + r""", f AS (
        SELECT book, chapter, stem AS name, coalesce(try_cast(nullif(regexp_extract(string_split(content, chr(10))[1], '% PAGES:\s*(\d+)', 1), '') AS INTEGER), 1000000000) AS p,
            regexp_extract_all(replace(replace(array_to_string(list_filter(string_split(content, chr(10)), lambda x: NOT regexp_matches(x, '^\s*%')), chr(10)), '\\[', 'x'), '\\]', 'x'), '\\(?:begin|end)\{\w+\*?\}|\\\[|\\\]') AS toks
        FROM tex WHERE stem LIKE 'sec%' AND book IS NOT NULL AND chapter IS NOT NULL
    ), one AS (SELECT book, chapter, flatten(list(list_transform(toks, lambda t: {'name': name, 't': t}) ORDER BY p, name NULLS FIRST, toks)) AS toks FROM f WHERE toks IS NOT NULL GROUP BY book, chapter),
    walk AS (
        SELECT book, chapter, toks, 1 AS i, CAST([] AS STRUCT(env VARCHAR, name VARCHAR)[]) AS stack, CAST([] AS STRUCT(name VARCHAR, code VARCHAR, env VARCHAR)[]) AS o, 0 AS depth, CAST(NULL AS VARCHAR) AS owner FROM one
        UNION ALL
        SELECT book, chapter, toks, i + 1,
            CASE WHEN starts_with(t, '\begin') THEN list_append(stack, {'env': env, 'name': name}) WHEN starts_with(t, '\end') AND len(stack) > 0 AND stack[-1].env = env THEN stack[:-2] ELSE stack END,
            CASE WHEN t = '\]' AND depth = 0 THEN list_append(o, {'name': name, 'code': 'display_end', 'env': '\]'})
                 WHEN starts_with(t, '\end') AND NOT coalesce(len(stack) > 0 AND stack[-1].env = env, false) THEN list_append(o, {'name': name, 'code': 'unmatched_end', 'env': env}) ELSE o END,
            CASE WHEN t = '\[' THEN depth + 1 WHEN t = '\]' THEN greatest(depth - 1, 0) ELSE depth END,
            CASE WHEN t = '\[' AND depth = 0 THEN name ELSE owner END
        FROM (SELECT *, toks[i].t AS t, toks[i].name AS name, regexp_extract(toks[i].t, '\{(.*)\}', 1) AS env FROM walk WHERE i <= len(toks))
    ), done AS (
        SELECT book, chapter, list_concat(list_concat(o, list_transform(stack, lambda e: {'name': e.name, 'code': 'unclosed', 'env': e.env})),
            CASE WHEN depth > 0 THEN [{'name': owner, 'code': 'display_unclosed', 'env': '\['}] ELSE CAST([] AS STRUCT(name VARCHAR, code VARCHAR, env VARCHAR)[]) END) AS v
        FROM walk WHERE i > len(toks)
    ), rows AS (SELECT book, chapter, unnest(v) AS v, generate_subscripts(v, 1) - 1 AS ord FROM done)
    SELECT book, chapter, CAST(ord AS INTEGER) AS ord, v.name AS name, v.code AS code, v.env AS env FROM rows"""
_LEFT = lambda where, pattern: f"""WITH {_FILES}, l AS (SELECT file_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS line_no FROM files WHERE {where})
    SELECT file_id, CAST(line_no AS INTEGER) AS line_no, line FROM l WHERE regexp_matches(line, '{pattern}')"""  # noqa: E731
SQL["leftover_notes"] = _LEFT("suffix IN ('tex', 'md', 'conf', 'txt', 'bib')", "UNCLEAR|TODO")
SQL["placeholder_images"] = _LEFT("suffix = 'tex'", r"placeholder\.png|\\includegraphics(?:\[[^\]]*\])?\{\s*\}|\\(?:input|include)\{\s*\}")
_NOTICED = r"""CASE length(text) % 11 WHEN 0 THEN chr(10) || 'ISBN 0-00' WHEN 1 THEN chr(10) || 'All Rights reserved.' WHEN 2 THEN chr(10) || 'Library of Congress'
    WHEN 3 THEN chr(10) || '\textcopyright{} 2020' WHEN 4 THEN chr(10) || '\Copyright' ELSE chr(10) || 'Copyright 2020' END"""
_MARKERS = r"""(VALUES ('isbn', '(?i)\bISBN\b'), ('all rights reserved', '(?i)all rights reserved'), ('library of congress', '(?i)library of congress'), ('textcopyright', '(?i)\\textcopyright'), ('copyright command', '(?i)\\copyright')) AS m(marker, p)"""
SQL["forbidden_scan"] = f"SELECT doc_id, marker FROM (SELECT doc_id, text || {_NOTICED} AS t FROM documents), {_MARKERS} WHERE regexp_matches(t, p)"
SQL["scrub_rescan"] = rf"""WITH given AS (SELECT CAST(doc_id AS VARCHAR) AS rel_path, '- **Publisher**: none' || chr(10) || '% Copyright page' || chr(10) || text || {_NOTICED} || chr(10) || '\cleardoublepage' || chr(10) AS old,
        CASE length(text) % 3 WHEN 0 THEN 'line' WHEN 1 THEN 'page' ELSE 'notice' END AS scrub FROM documents WHERE text IS NOT NULL),
    done AS (SELECT *, CASE scrub WHEN 'line' THEN regexp_replace(old, '(?m)^- \*\*Publisher\*\*:.*\n', '', 'g')
        WHEN 'page' THEN regexp_replace(old, '(?s)% Copyright page\n.*?\\cleardoublepage\n', '', 'g')
        ELSE regexp_replace(regexp_replace(old, '(?i)\n(?:ISBN 0-00|All rights reserved\.|Library of Congress|\\textcopyright\{{\}} 2020|\\copyright)\n', chr(10), 'g'), '(?s)\nCopyright 2020.*?\\cleardoublepage\s*\z', '', 'g') END AS c FROM given)
    SELECT rel_path, scrub, CASE WHEN EXISTS (SELECT 1 FROM {_MARKERS} WHERE regexp_matches(c, p)) THEN 'failed' WHEN c = old THEN 'unchanged' ELSE 'scrubbed' END AS status,
        CAST(length(old) - length(c) AS BIGINT) AS removed_chars FROM done"""
_FIG_ENV = r"(?s)\\begin\{figure\}.*?\\end\{figure\}"
SQL["figure_paths"] = _TEX + rf""", f AS (SELECT file_id, book, content FROM tex WHERE book IS NOT NULL AND content IS NOT NULL),
    figs AS (SELECT DISTINCT book, replace(regexp_extract(l, 'fig:([\d_]+)', 1), '_', '.') AS fig FROM (SELECT book, unnest(regexp_extract_all(content, '\\label\{{fig:\d+_\d+(?:_\d+)?\}}')) AS l FROM f)),
    maps AS (SELECT book, map(list(fig), list('figures/ch' || left(lpad(string_split(fig, '.')[1], 2, '0'), 2) || '/fig_' || replace(fig, '.', '_') || '.png')) AS m FROM figs WHERE length(fig) % 2 = 1 GROUP BY book),
    parts AS (SELECT file_id, content, m, regexp_split_to_array(content, '{_FIG_ENV}') AS o, regexp_extract_all(content, '{_FIG_ENV}') AS i FROM f LEFT JOIN maps USING (book)),
    done AS (SELECT file_id, content, CASE WHEN m IS NULL THEN content ELSE array_to_string(list_transform(range(1, len(o) + 1), lambda k: o[k] || coalesce(
        CASE WHEN m[replace(regexp_extract(i[k], '\\label\{{[^}}]*?(\d+(?:[._]\d+){{1,2}})\}}', 1), '_', '.')] IS NOT NULL
             THEN regexp_replace(i[k], '\\includegraphics(?:\[[^\]]*\])?\{{[^}}]*\}}', '\\includegraphics[width=0.8\\textwidth]{{' || m[replace(regexp_extract(i[k], '\\label\{{[^}}]*?(\d+(?:[._]\d+){{1,2}})\}}', 1), '_', '.')] || '}}')
             ELSE i[k] END, '')), '') END AS c FROM parts)
    SELECT file_id, c <> content AS changed, md5(c) AS content_md5 FROM done"""
SQL["figure_reconcile"] = _TEX + r""", f AS (SELECT book, content FROM tex WHERE book IS NOT NULL AND content IS NOT NULL),
    l AS (SELECT DISTINCT book, unnest(regexp_extract_all(content, '\\label\{fig:([\d_]+)\}', 1)) AS fig FROM f), r AS (SELECT DISTINCT book, unnest(regexp_extract_all(content, 'fig_([\d_]+)\.png', 1)) AS fig FROM f)
    SELECT coalesce(l.book, r.book) AS book, coalesce(l.fig, r.fig) AS fig, CASE WHEN r.fig IS NULL THEN 'only_left' WHEN l.fig IS NULL THEN 'only_right' ELSE 'both' END AS side
    FROM l FULL JOIN r ON l.book = r.book AND l.fig = r.fig"""

# --- configurations and identity ----------------------------------------------------------------------------------------
SQL["config_keys"] = f"WITH {_FILES}" + r""", l AS (SELECT file_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS n FROM files WHERE suffix = 'conf'),
    e AS (SELECT file_id, n, regexp_extract(line, '^\s*([A-Z0-9_]+)\s*=\s*(.*?)\s*$', 1) AS key, regexp_extract(line, '^\s*([A-Z0-9_]+)\s*=\s*(.*?)\s*$', 2) AS v FROM l
        WHERE regexp_matches(line, '^\s*[A-Z0-9_]+\s*=\s*.*?\s*$') AND NOT regexp_matches(line, '^\s*#'))
    SELECT file_id, key, CASE WHEN length(v) >= 2 AND left(v, 1) = right(v, 1) AND left(v, 1) IN ('"', '''') THEN substr(v, 2, length(v) - 2) ELSE v END AS value
    FROM e QUALIFY row_number() OVER (PARTITION BY file_id, key ORDER BY n DESC) = 1"""
SQL["config_chapter_ranges"] = f"WITH {_FILES}" + r""", m AS (SELECT file_id, unnest(regexp_extract_all(content, 'CH\d+_PAGES="\d+-\d+"')) AS x FROM files WHERE suffix = 'conf')
    SELECT DISTINCT file_id, try_cast(regexp_extract(x, 'CH(\d+)', 1) AS INTEGER) AS chapter, try_cast(regexp_extract(x, '"(\d+)-', 1) AS INTEGER) AS start_page, try_cast(regexp_extract(x, '-(\d+)"', 1) AS INTEGER) AS end_page FROM m"""
_CONFS = """c AS (SELECT book, conf FROM (SELECT * FROM book_conf WHERE revision IS NOT NULL QUALIFY row_number() OVER (PARTITION BY book, revision ORDER BY loaded_at DESC NULLS LAST) = 1)
    QUALIFY row_number() OVER (PARTITION BY book ORDER BY revision DESC) = 1)"""
_REASONS = r"""list_filter([
        CASE WHEN nullif(trim(conf['PAGE_COUNT']), '') IS NULL THEN 'no_page_count'
             WHEN NOT regexp_full_match(trim(conf['PAGE_COUNT']), '[+-]?[0-9]+') THEN 'page_count_not_integer:' || trim(conf['PAGE_COUNT'])
             WHEN try_cast(trim(conf['PAGE_COUNT']) AS INTEGER) IS DISTINCT FROM real_pages THEN 'different_book:' || trim(conf['PAGE_COUNT']) || '<>' || coalesce(CAST(real_pages AS VARCHAR), '?') END,
        nullif('missing:' || array_to_string(list_sort(list_concat(list_filter(['PAGE_OFFSET', 'COPYRIGHT_PAGE', 'FIGURE_NUMBERING', 'BACKMATTER_PAGES'], lambda k: coalesce(trim(conf[k]), '') = ''),
            CASE WHEN len(list_filter(map_keys(conf), lambda k: regexp_full_match(k, 'CH[0-9]+_PAGES'))) > 0 THEN [] ELSE ['CHNN_PAGES'] END)), ','), 'missing:')
    ], lambda r: r IS NOT NULL)"""
SQL["identity_reasons"] = f"""WITH {_CONFS}, p AS (SELECT book, max(end_page) + 1 AS real_pages FROM chapter_range GROUP BY book)
    SELECT book, array_to_string({_REASONS}, '; ') AS reasons FROM c LEFT JOIN p USING (book)"""
SQL["identity_decisions"] = rf"""WITH {_CONFS}, n AS (SELECT book, conf, 'pdfs/' || regexp_extract(book, '_([a-z-]+)_\d+$', 1) || '.pdf' AS pdf FROM c),
    pdfs AS (SELECT pdf, max(try_cast(nullif(regexp_extract(conf['PAGE_COUNT'], '^\s*(\d+)\s*$', 1), '') AS INTEGER)) AS real_pages FROM n GROUP BY pdf),
    claims AS (SELECT pdf, book, len(list_filter({_REASONS}, lambda r: NOT starts_with(r, 'missing:'))) = 0 AS ok FROM n JOIN pdfs USING (pdf)),
    a AS (SELECT pdf, count(*) AS claimants, count(*) FILTER (ok) AS verified, max(book) FILTER (ok) AS one FROM claims GROUP BY pdf)
    SELECT pdf, CASE WHEN claimants = 0 THEN 'FRESH' WHEN verified = 1 THEN 'RESUME' ELSE 'STOP' END AS decision, CASE WHEN verified = 1 THEN one END AS book, claimants, verified FROM a
    UNION ALL SELECT 'other/' || pdf, 'FRESH', NULL, 0, 0 FROM pdfs"""

# --- contents and page ranges -------------------------------------------------------------------------------------------
SQL["page_chunks"] = f"""WITH {_RANGES}, s AS (SELECT book, chapter, end_page, unnest(range(start_page, end_page + 1, 6)) AS s FROM ranges WHERE start_page <= end_page)
    SELECT book, chapter, CAST(s AS INTEGER) AS chunk_start, CAST(least(s + 5, end_page) AS INTEGER) AS chunk_end FROM s"""
SQL["page_ownership"] = f"""WITH {_RANGES}, r AS (SELECT book, chapter, start_page, end_page + 1 AS end_page FROM ranges WHERE start_page <= end_page + 1)
    SELECT a.book, a.chapter AS a, b.chapter AS b FROM r a JOIN r b ON a.book = b.book AND a.chapter < b.chapter AND a.start_page <= b.end_page AND b.start_page <= a.end_page"""
SQL["slugs"] = rf"""WITH {_RANGES}, t AS (SELECT book, chapter, title || CASE WHEN chapter % 3 = 0 THEN ': A Survey with Notes' ELSE '' END AS t FROM ranges WHERE title IS NOT NULL)
    SELECT book, chapter, substr(string_split(regexp_replace(trim(regexp_replace(lower(t), '[^a-z0-9\s]', '', 'g'), ' ' || chr(9) || chr(10)), '\s+', '_', 'g'), '_with_')[1], 1, 50) AS slug FROM t"""
SQL["toc_ranges"] = rf"""WITH {_RANGES}, r AS (SELECT *, length(book) % 3 AS style FROM ranges WHERE title IS NOT NULL AND start_page IS NOT NULL),
    l AS (SELECT *, CASE style WHEN 0 THEN 'Chapter ' || chapter || ' ' || title || ' .... ' || start_page WHEN 1 THEN chapter || '.  ' || title || '    ' || start_page ELSE chapter || '  ' || title || '  ' || start_page END AS line FROM r),
    t AS (SELECT book, string_agg(line, chr(10) ORDER BY chapter) AS t, max(start_page) + 20 AS n FROM l GROUP BY book),
    p AS (SELECT book, n, t, CASE WHEN len(regexp_extract_all(t, p1)) > 0 THEN p1 WHEN len(regexp_extract_all(t, p2)) > 0 THEN p2 ELSE p3 END AS p FROM t,
        (SELECT '(?m)(?:Chapter\s+)?(\d{{1,2}})\s+([A-Z][^\d\n]{{5,}}?)\s*\.{{0,}}\s*(\d{{1,4}})\s*$' AS p1, '(?m)^(\d{{1,2}})\.\s+([A-Z][^\d\n]{{5,}}?)\s+(\d{{1,4}})\s*$' AS p2, '(?m)^(\d{{1,2}})\s{{2,}}([A-Z][^\d\n]{{5,}}?)\s{{2,}}(\d{{1,4}})\s*$' AS p3)),
    e AS (SELECT book, n, unnest(regexp_extract_all(t, p, 1)) AS c, unnest(regexp_extract_all(t, p, 2)) AS title, unnest(regexp_extract_all(t, p, 3)) AS page FROM p),
    k AS (SELECT book, n, CAST(c AS INTEGER) AS chapter, regexp_replace(trim(title), '\.+$', '') AS title, CAST(page AS INTEGER) AS page FROM e WHERE CAST(c AS INTEGER) BETWEEN 1 AND 30 AND CAST(page AS INTEGER) < n
        QUALIFY row_number() OVER (PARTITION BY book, CAST(c AS INTEGER) ORDER BY trim(title), CAST(page AS INTEGER)) = 1)
    SELECT book, chapter, title, page AS start_page, CAST(coalesce(lead(page) OVER (PARTITION BY book ORDER BY chapter) - 1, n - 1) AS INTEGER) AS end_page FROM k"""
SQL["first_lines"] = r"""SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '')[1] AS title FROM documents"""
SQL["front_text"] = f"""WITH {_PAGES}, t AS (SELECT pdf, string_agg('--- Page ' || page_num || ' ---' || chr(10) || coalesce(text, ''), chr(10) || chr(10) ORDER BY page_num, coalesce(text, '')) AS t
    FROM pages WHERE pdf IS NOT NULL AND page_num <= 20 GROUP BY pdf) SELECT pdf, CAST(length(t) AS BIGINT) AS chars, md5(t) AS text_md5 FROM t"""
SQL["text_layer"] = rf"""WITH {_PAGES} SELECT pdf, count(*) AS pages, CAST(sum(coalesce(length(regexp_replace(text, '^\s+|\s+$', '', 'g')), 0)) AS BIGINT) AS text_chars,
    sum(coalesce(length(regexp_replace(text, '^\s+|\s+$', '', 'g')), 0)) = 0 AS needs_ocr FROM pages GROUP BY pdf"""
SQL["split_output"] = _TEX + r""", t AS (SELECT book, chapter, string_agg('%%% FILE: ' || stem || '.tex %%%' || chr(10) || content, chr(10) ORDER BY stem, file_id) AS t FROM tex
        WHERE stem LIKE 'sec%' AND book IS NOT NULL AND chapter IS NOT NULL AND content IS NOT NULL GROUP BY book, chapter),
    s AS (SELECT book, chapter, t, regexp_extract_all(t, '%%%\s*FILE:\s*(sec\d+_\d+\.tex)\s*%%%', 1) AS n, regexp_split_to_array(t, '%%%\s*FILE:\s*sec\d+_\d+\.tex\s*%%%') AS b FROM t),
    e AS (SELECT book, chapter, unnest(range(0, greatest(len(n), 1))) AS ord, t, n, b FROM s),
    o AS (SELECT book, chapter, CAST(ord AS INTEGER) AS ord, CASE WHEN len(n) = 0 THEN 'sec' || lpad(CAST(chapter AS VARCHAR), 2, '0') || '_1.tex' ELSE n[ord + 1] END AS filename,
        CASE WHEN len(n) = 0 THEN t ELSE regexp_replace(b[ord + 2], '^\s+|\s+$', '', 'g') END || chr(10) AS c FROM e)
    SELECT book, chapter, ord, filename, CAST(length(c) AS BIGINT) AS chars, md5(c) AS content_md5 FROM o"""
SQL["unconverted_chapters"] = f"""WITH {_RANGES} SELECT book, chapter FROM ranges r WHERE NOT EXISTS (SELECT 1 FROM source_file s WHERE s.suffix = 'tex' AND starts_with(s.stem, 'sec') AND s.book = r.book AND s.chapter = r.chapter)"""
SQL["written_configs"] = f"""WITH {_RANGES}, r AS (SELECT * FROM ranges WHERE start_page IS NOT NULL AND end_page IS NOT NULL),
    w AS (SELECT book, array_to_string(list_transform(string_split(book, '_'), lambda x: upper(x[1]) || x[2:]), ' ') AS title, count(*) AS n,
        string_agg('CH' || lpad(CAST(chapter AS VARCHAR), 2, '0') || '_PAGES="' || start_page || '-' || end_page || '"', chr(10) ORDER BY chapter) AS body FROM r GROUP BY book)
    SELECT book, 'BOOK_NAME="' || book || '"' || chr(10) || 'TITLE="' || title || '"' || chr(10) || 'AUTHOR=""' || chr(10) || 'EDITION="2nd"' || chr(10) || 'PUBLISHER=""' || chr(10) || 'NUM_CHAPTERS=' || n || chr(10) || chr(10) || body || chr(10) AS text FROM w"""
SQL["written_wrappers"] = _TEX + f", {_RANGES}" + r""", s AS (SELECT DISTINCT book, chapter, stem, coalesce(try_cast(nullif(regexp_extract(string_split(content, chr(10))[1], '% PAGES:\s*(\d+)', 1), '') AS INTEGER), 1000000000) AS p,
        try_cast(nullif(regexp_extract(stem, '_(\d+)$', 1), '') AS INTEGER) AS n FROM tex WHERE stem LIKE 'sec%' AND book IS NOT NULL AND chapter IS NOT NULL),
    b AS (SELECT book, chapter, string_agg('\input{ch' || lpad(CAST(chapter AS VARCHAR), 2, '0') || '/' || stem || '}', chr(10) ORDER BY p, n NULLS FIRST, stem) AS body FROM s GROUP BY book, chapter)
    SELECT b.book, b.chapter, '\chapter{' || coalesce(r.title, 'Chapter ' || b.chapter) || '}' || chr(10) || '\label{ch:' || b.chapter || '}' || chr(10) || chr(10) || body || chr(10) AS text FROM b LEFT JOIN ranges r USING (book, chapter)"""
SQL["written_progress"] = f"""WITH {_RANGES}, r AS (SELECT *, EXISTS (SELECT 1 FROM source_file s WHERE s.suffix = 'tex' AND s.stem LIKE 'sec%' AND s.book = x.book AND s.chapter = x.chapter) AS done FROM ranges x WHERE start_page IS NOT NULL AND end_page IS NOT NULL)
    SELECT book, '| Chapter | Title | Pages | Done |' || chr(10) || '|---|---|---|---|' || chr(10) || string_agg('| ' || chapter || ' | ' || coalesce(title, '') || ' | ' || start_page || '-' || end_page || ' | ' || CASE WHEN done THEN '[x]' ELSE '[ ]' END || ' |', chr(10) ORDER BY chapter) || chr(10) AS text FROM r GROUP BY book"""

# --- logs -----------------------------------------------------------------------------------------------------------------
_LOG = r"""WITH lines AS (SELECT user_id AS log_id, event_id AS line_no, CASE event_type
        WHEN 'error' THEN './ch0' || event_id % 7 || '/sec.tex:' || event_id % 50 || ': Undefined control sequence ' || event_id % 3
        WHEN 'click' THEN '! Missing $ inserted ' || event_id % 4
        WHEN 'view' THEN '(./ch0' || event_id % 5 || '/a.tex (./b' || event_id % 3 || '.sty'
        WHEN 'signup' THEN 'l.' || event_id % 90 || ' \foo'
        ELSE 'Overfull \hbox ' || event_id % 10 END AS line FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL),
    marked AS (SELECT *, CASE WHEN contains(line, '(./') THEN './b' || regexp_extract(line, 'b(\d)\.sty', 1) || '.sty' END AS opens, try_cast(nullif(regexp_extract(line, '^l\.(\d+)[\s.]', 1), '') AS INTEGER) AS echo FROM lines),
    near AS (SELECT *, last_value(opens IGNORE NULLS) OVER (PARTITION BY log_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nf,
        first_value(echo IGNORE NULLS) OVER (PARTITION BY log_id ORDER BY line_no ROWS BETWEEN 1 FOLLOWING AND 10 FOLLOWING) AS nl,
        left(array_to_string(list(line) OVER (PARTITION BY log_id ORDER BY line_no ROWS BETWEEN CURRENT ROW AND 5 FOLLOWING), chr(10)), 200) AS context FROM marked),
    e AS (SELECT log_id, line_no, CASE WHEN line LIKE '!%' THEN trim(substr(line, 2)) ELSE regexp_extract(line, ':\d+:\s*(.*)$', 1) END AS message,
        CASE WHEN line LIKE '!%' THEN nf ELSE regexp_extract(line, '^([^:]+):', 1) END AS file, CASE WHEN line LIKE '!%' THEN nl ELSE CAST(regexp_extract(line, ':(\d+):', 1) AS INTEGER) END AS line, context
        FROM near WHERE line LIKE '!%' OR line LIKE '%.tex:%'),
    errors AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY log_id, file, line, message ORDER BY line_no) = 1)"""
SQL["log_errors"] = _LOG + " SELECT log_id, line_no, message, file, line, context FROM errors"
SQL["log_error_files"] = _LOG + " SELECT file, count(*) AS errors FROM errors WHERE file IS NOT NULL GROUP BY file ORDER BY errors DESC, file LIMIT 10"
SQL["log_error_files_all"] = _LOG + " SELECT file, count(*) AS errors FROM errors WHERE file IS NOT NULL GROUP BY file"
SQL["log_error_files_rest"] = _LOG + ", beyond AS (SELECT file, count(*) AS n FROM errors WHERE file IS NOT NULL GROUP BY file ORDER BY n DESC, file OFFSET 10) SELECT count(*) AS files, CAST(coalesce(sum(n), 0) AS BIGINT) AS errors FROM beyond"
_WIDTH = f"""WITH {_PAGES}, l AS (SELECT ocr_id AS log_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM pages WHERE text IS NOT NULL),
    h AS (SELECT log_id, length(line) AS len, count(*) AS c FROM l GROUP BY ALL),
    top AS (SELECT log_id, len AS width, c FROM h WHERE len >= 60 QUALIFY row_number() OVER (PARTITION BY log_id ORDER BY c DESC, len) = 1),
    widths AS (SELECT t.log_id, width FROM top t JOIN h USING (log_id) WHERE t.c >= 5 GROUP BY t.log_id, width HAVING coalesce(sum(h.c) FILTER (h.len > width), 0) <= greatest(3, sum(h.c) // 50))"""
SQL["wrap_width"] = _WIDTH + " SELECT log_id, CAST(width AS INTEGER) AS width FROM widths"

# --- figures --------------------------------------------------------------------------------------------------------------
_ROM = "['I', 'II', 'III', 'IV', 'V']"
_PARTS = f"""WITH t AS (SELECT p_size AS book, p_partkey AS page, p_partkey % 5 + 1 AS a, p_partkey % 13 AS b, p_partkey % 3 AS c, p_partkey % 4 AS e, p_partkey % 30 AS f,
    {_ROM}[CAST(p_partkey % 5 + 1 AS INTEGER)] AS r, (p_partkey % 20) || CASE WHEN p_partkey % 2 = 0 THEN 'a' ELSE '' END AS g FROM part)"""
_PATH = "'figures/ch' || left(lpad(CAST(chapter AS VARCHAR), 2, '0'), 2) || '/fig_' || replace(replace(fig_id, '.', '_'), '-', '_') || '.png'"
# two-part backs off: of a three-part caption c.e.f it takes c and e without its last digit, if e has two digits
SQL["captions_found"] = _PARTS + f""", o AS (
        SELECT 'two-part' AS style, page, 0 AS ord, CAST(a AS INTEGER) AS chapter, a || '.' || b AS fig_id FROM t
        UNION ALL SELECT 'two-part', page, 1, CAST(c AS INTEGER), c || '.' || (e // 10) FROM t WHERE e >= 10
        UNION ALL SELECT 'two-part-strict', page, 0, CAST(a AS INTEGER), a || '.' || b FROM t
        UNION ALL SELECT 'three-part', page, 0, CAST(c AS INTEGER), c || '.' || e || '.' || f FROM t
        UNION ALL SELECT 'roman', page, 0, CASE r WHEN 'I' THEN 1 WHEN 'II' THEN 2 WHEN 'III' THEN 3 WHEN 'IV' THEN 4 END, r || '-' || g FROM t WHERE r <> 'V')
    SELECT style, page, CAST(ord AS INTEGER) AS ord, chapter, fig_id, {_PATH} AS path FROM o"""
_THREE = _PARTS + ", o AS (SELECT book, page, CAST(c AS INTEGER) AS chapter, c || '.' || e || '.' || f AS fig_id FROM t QUALIFY row_number() OVER (PARTITION BY book, c, e, f ORDER BY page) = 1)"
SQL["figures_first"] = _THREE + " SELECT book, fig_id, chapter, page FROM o"
SQL["figures_per_chapter"] = _THREE + " SELECT book, chapter, count(*) AS figures, arg_min(fig_id, page) AS first_id, arg_max(fig_id, page) AS last_id FROM o GROUP BY book, chapter"
SQL["crop_rectangles"] = """WITH b AS (SELECT l_orderkey AS page, CAST(l_orderkey % 640 + 100 AS DOUBLE) AS y, CAST(l_partkey % 700 AS DOUBLE) + l_quantity AS y1, l_linenumber % 3 = 0 AS fig, l_suppkey % 90 AS n FROM lineitem),
    g AS (SELECT page, any_value(y) AS y, max(y1) FILTER (n > 50 AND NOT fig AND y1 < y - 10) AS t, max(y1) FILTER (y1 < y - 5 AND n + CASE WHEN NOT fig THEN 0 WHEN n = 0 THEN 6 ELSE 7 END > 50) AS r, count(*) FILTER (y1 < y - 5) AS above FROM b GROUP BY page),
    h AS (SELECT *, CASE WHEN above > 0 THEN coalesce(r + 5, greatest(30, y - 300)) ELSE 30 END AS top FROM g)
    SELECT page, round(greatest(coalesce(t + 5, 30), y - 350, 20), 6) AS text_y0, round(least(y + 40, 782), 6) AS text_y1, round(greatest(30, y * 2 / (150.0 / 72) - 280), 6) AS ocr_y0, round(y * 2 / (150.0 / 72) + 25, 6) AS ocr_y1,
        round(CASE WHEN y - top < 50 THEN greatest(30, y - 200) ELSE top END, 6) AS nearest_y0, round(y + 22, 6) AS nearest_y1, round(greatest(0, y - 200), 6) AS above_y0, round(y + 16, 6) AS above_y1 FROM h"""
SQL["nearest_blocks"] = """SELECT o_orderkey AS page, CAST(o_orderkey % 640 + 100 AS DOUBLE) AS caption_y, max(l_partkey % 700 + l_quantity) AS nearest_bottom
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_partkey % 700 + l_quantity < o_orderkey % 640 + 90 GROUP BY o_orderkey"""

# --- results ------------------------------------------------------------------------------------------------------------
_RES = "WITH r AS (SELECT * FROM filter_test_result QUALIFY row_number() OVER (PARTITION BY result_id ORDER BY loaded_at DESC NULLS LAST) = 1)"
SQL["results_summary"] = _RES + """ SELECT suite, model, count(*) AS tests, count(*) FILTER (lower(trim(status)) = 'success') AS success, count(*) FILTER (lower(trim(status)) = 'blocked') AS blocked,
    count(*) - count(*) FILTER (lower(trim(status)) = 'success') - count(*) FILTER (lower(trim(status)) = 'blocked') AS other, CAST(sum(coalesce(output_length, 0)) AS BIGINT) AS output_chars,
    round(avg(latency_ms), 3) AS mean_latency_ms, 2 - grouping(suite) - grouping(model) AS level FROM r GROUP BY ROLLUP (suite, model)"""
SQL["result_errors"] = _RES + """ SELECT result_id, CASE WHEN coalesce(error_message, '') = '' THEN NULL WHEN contains(lower(error_message), 'content filtering policy') OR contains(lower(error_message), 'output blocked') THEN 'blocked'
    WHEN regexp_matches(error_message, '429|rate_limit|529|overloaded') THEN 'retry' ELSE 'error' END AS error_class, coalesce(contains(test_name, 'metadata') OR contains(test_name, 'title'), false) AS holds_metadata FROM r"""

SQL["progress_shares"] = f"""WITH {_RANGES}, r AS (SELECT DISTINCT book, chapter, title, start_page, end_page, EXISTS (SELECT 1 FROM source_file s WHERE s.suffix = 'tex' AND s.stem LIKE 'sec%' AND s.book = x.book AND s.chapter = x.chapter) AS done
        FROM ranges x WHERE start_page IS NOT NULL AND end_page IS NOT NULL)
    SELECT book, count(*) AS items, count(*) FILTER (done) AS done, 1 - grouping(book) AS level, round(count(*) FILTER (done) / count(*), 6) AS share FROM r GROUP BY ROLLUP (book)"""
SQL["chapter_page_text"] = f"""WITH {_PAGES}, {_RANGES}, s AS (SELECT DISTINCT 'pdfs/' || book || '.pdf' AS pdf, start_page, end_page FROM ranges WHERE start_page <= end_page),
    t AS (SELECT s.pdf, s.start_page, s.end_page, string_agg('--- Page ' || page_num || ' ---' || chr(10) || coalesce(text, ''), chr(10) || chr(10) ORDER BY page_num, coalesce(text, '')) AS t
        FROM s JOIN pages p ON p.pdf = s.pdf AND p.page_num BETWEEN s.start_page AND s.end_page GROUP BY ALL)
    SELECT pdf, start_page, end_page, CAST(length(t) AS BIGINT) AS chars, md5(t) AS text_md5 FROM t"""
SQL["printed_pages"] = f"""WITH {_PAGES}, t AS (SELECT pdf, page_num, '=== PDF page ' || page_num || ', printed page ' || (page_num - 11) || ' ===' || chr(10) || coalesce(text, '') || chr(10) AS t
    FROM pages WHERE pdf IS NOT NULL AND page_num IS NOT NULL) SELECT pdf, page_num, CAST(length(t) AS BIGINT) AS chars, md5(t) AS piece_md5 FROM t"""
SQL["log_errors_of_all"] = _LOG + """, none AS (SELECT DISTINCT c_custkey AS log_id FROM customer WHERE c_custkey NOT IN (SELECT log_id FROM lines)),
    all_ AS (SELECT log_id, false AS no_log FROM errors UNION ALL SELECT log_id, true FROM none)
    SELECT no_log, count(*) AS errors, count(DISTINCT log_id) AS logs FROM all_ GROUP BY no_log"""
SQL["first_captions"] = _PARTS + """ SELECT 'two-part' AS style, page, a || '.' || b AS fig_id, round(page % 900 / (150.0 / 72), 6) AS caption_y FROM t
    UNION ALL SELECT 'three-part', page, c || '.' || e || '.' || f, round(page % 900 / (150.0 / 72), 6) FROM t
    UNION ALL SELECT 'roman', page, r || '-' || g, round(page % 900 / (150.0 / 72), 6) FROM t WHERE r <> 'V'"""

# --- every key of a configuration -------------------------------------------------------------------------------------
_ALL_HELD = _P1_HELD.replace(
    "           END AS field\n    FROM pairs",
    r"""           ELSE upper(trim(regexp_replace(regexp_replace(key, '([a-z0-9])([A-Z])', '\1_\2', 'g'), '[^A-Za-z0-9]+', '_', 'g'), '_'))
           END AS field
    FROM pairs""",
)
SQL["p1_schema"] = _ALL_HELD + """SELECT field, key, type, count(*) AS revisions, count(DISTINCT book) AS books, min(revision) AS first_revision, max(revision) AS last_revision
    FROM held GROUP BY field, key, type"""
SQL["p1_values"] = _ALL_HELD + "SELECT book, revision, field, key, type, v AS value FROM held"
SQL["p1_changes"] = (
    _ALL_HELD
    + """, steps AS (SELECT book, revision, lag(revision) OVER (PARTITION BY book ORDER BY revision) AS before FROM latest),
    now AS (SELECT s.book, s.revision, h.field, h.key, h.type FROM steps s JOIN held h ON h.book IS NOT DISTINCT FROM s.book AND h.revision = s.revision WHERE s.before IS NOT NULL),
    old AS (SELECT s.book, s.revision, h.field, h.key, h.type FROM steps s JOIN held h ON h.book IS NOT DISTINCT FROM s.book AND h.revision = s.before),
    pair AS (SELECT coalesce(n.book, o.book) AS book, coalesce(n.revision, o.revision) AS revision, coalesce(n.field, o.field) AS field, o.key AS ok, n.key AS nk, o.type AS ot, n.type AS nt
             FROM now n FULL JOIN old o ON o.book IS NOT DISTINCT FROM n.book AND o.revision = n.revision AND o.field = n.field)
    SELECT book, revision, field, 'added' AS change FROM pair WHERE ok IS NULL UNION ALL SELECT book, revision, field, 'removed' FROM pair WHERE nk IS NULL
    UNION ALL SELECT book, revision, field, 'renamed' FROM pair WHERE ok <> nk UNION ALL SELECT book, revision, field, 'retyped' FROM pair WHERE ot <> nt"""
)

# --- checks ---------------------------------------------------------------------------------------------------------------
SQL["placeholder_planted"] = rf"""WITH {_FILES}, planted AS (SELECT file_id, regexp_replace(content, 'fig_[0-9_]+\.png', 'placeholder.png', 'g') AS content FROM files WHERE suffix = 'tex'),
    l AS (SELECT file_id, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS line_no FROM planted)
    SELECT file_id, CAST(line_no AS INTEGER) AS line_no, line FROM l WHERE contains(line, 'placeholder.png')"""
SQL["layout_of_all_books"] = _LAYOUT.replace("(SELECT DISTINCT book FROM source_file WHERE book IS NOT NULL)", "(SELECT DISTINCT book FROM (SELECT book FROM source_file UNION ALL SELECT book FROM chapter_range) WHERE book IS NOT NULL)")
SQL["legacy_paths"] = r"""WITH p AS (SELECT DISTINCT CASE WHEN starts_with(rel_path, 'scripts/') THEN 'docs/progress.md' ELSE rel_path END AS p FROM source_file WHERE book IS NOT NULL AND length(book) % 3 = 0),
    x AS (SELECT DISTINCT CASE WHEN p IN ('book.conf', 'docs/progress.md') THEN p WHEN regexp_matches(p, '^latex/ch[^/]*/') THEN regexp_extract(p, '^(latex/ch[^/]*)/', 1) END AS path FROM p)
    SELECT path, CASE WHEN starts_with(path, 'latex/') THEN 'chapter_dir' ELSE 'file' END AS code FROM x WHERE path IS NOT NULL"""
_SIX = f"""all_ AS (
    SELECT 'layout' AS "check", book AS scope, rel_path AS object, 'missing' AS code FROM ({SQL["layout_required"]})
    UNION ALL SELECT 'wrapper', book, stem, code FROM ({SQL["wrapper_integrity"]})
    UNION ALL SELECT 'balance', book, name, code FROM ({SQL["env_balance"]})
    UNION ALL SELECT 'marker', NULL, CAST(doc_id AS VARCHAR), marker FROM ({SQL["forbidden_scan"]})
    UNION ALL SELECT 'leftover', f.book, CAST(x.file_id AS VARCHAR), 'note' FROM ({SQL["leftover_notes"]}) x JOIN of_file f USING (file_id)
    UNION ALL SELECT 'image', f.book, CAST(x.file_id AS VARCHAR), 'placeholder' FROM ({SQL["placeholder_planted"]}) x JOIN of_file f USING (file_id)
)"""
_OF_FILE = "of_file AS (SELECT DISTINCT file_id, book FROM source_file)"
SQL["violations_all"] = f"""WITH {_OF_FILE}, {_SIX} SELECT "check", code, count(*) AS n, count(DISTINCT scope) AS scopes FROM all_ GROUP BY ALL"""
SQL["violations_of_a_book"] = f"""WITH {_OF_FILE}, {_SIX}, most AS (SELECT book FROM of_file WHERE book IS NOT NULL GROUP BY book ORDER BY count(*) DESC, book LIMIT 1)
    SELECT "check", object, code, count(*) AS n FROM all_ WHERE scope = (SELECT book FROM most) GROUP BY ALL"""

# --- progress, names, paths ------------------------------------------------------------------------------------------------
SQL["check_lists"] = f"""WITH {_RANGES}, r AS (SELECT * FROM ranges WHERE title IS NOT NULL AND start_page IS NOT NULL)
    SELECT book, chapter, 2 AS line_no, trim(title) AS section, 'pages from ' || start_page AS item, chapter % 2 = 0 AS done FROM r
    UNION ALL SELECT book, chapter, 4, trim(title), 'chapter ' || chapter, true FROM r"""
SQL["missing_stubs"] = f"""WITH {_RANGES} SELECT DISTINCT book, chapter FROM ranges r WHERE NOT EXISTS (SELECT 1 FROM source_file s WHERE s.book = r.book AND s.chapter = r.chapter)"""
SQL["progress_sources"] = """SELECT book, arg_min(rel_path, r) AS rel_path FROM (
    SELECT book, rel_path, CASE rel_path WHEN 'progress.md' THEN 1 WHEN 'latex/ch01/ch01.tex' THEN 2 WHEN 'book.conf' THEN 3 END AS r FROM source_file WHERE book IS NOT NULL) WHERE r IS NOT NULL GROUP BY book"""
SQL["book_names"] = r"""SELECT name, coalesce(name <> '' AND NOT contains(name, '/') AND NOT contains(name, '\') AND NOT contains(name, '..'), false) AS plain
    FROM (SELECT stem AS name FROM source_file UNION SELECT rel_path FROM source_file UNION SELECT stem || '..' FROM source_file UNION SELECT '')"""
SQL["relative_paths"] = r"""SELECT DISTINCT file_id, CASE file_id % 3 WHEN 2 THEN './' || rel_path ELSE replace(rel_path, '\', '/') END AS path FROM source_file"""
SQL["suite_history"] = _RES + """, s AS (SELECT min(suite) AS suite FROM r)
    SELECT result_id, suite, model, CASE WHEN latency_ms IS NULL THEN 'old' END AS note, latency_ms FROM r WHERE suite = (SELECT suite FROM s)"""
SQL["located_captions"] = """WITH spans AS (
        SELECT l_orderkey AS page, 'Figure ' || l_partkey % 5 || CASE WHEN l_suppkey % 2 = 0 THEN '-1' ELSE '–1' END AS span_text, l_linenumber * CAST(1000000 AS BIGINT) + l_suppkey AS ord, l_suppkey AS s FROM lineitem
    ), one AS (SELECT page, span_text, arg_min(s, ord) AS s FROM spans GROUP BY ALL),
    w AS (SELECT o_orderkey AS page, 'Figure ' || o_custkey % 5 || '-1' AS caption, 'Figure ' || o_custkey % 5 || '–1' AS dashed FROM orders),
    g AS (SELECT w.page, caption, coalesce(a.s, b.s) AS s FROM w LEFT JOIN one a ON a.page = w.page AND a.span_text = caption LEFT JOIN one b ON b.page = w.page AND b.span_text = dashed)
    SELECT page, caption, CAST(s % 7 AS DOUBLE) AS x0, CAST(s % 11 AS DOUBLE) AS y0, CAST(s % 13 AS DOUBLE) AS x1, CAST(s % 17 AS DOUBLE) AS y1 FROM g"""

# --- logs: joined line by line ----------------------------------------------------------------------------------------------
SQL["log_unwrapped"] = (
    _WIDTH.replace("WITH pages", "WITH RECURSIVE pages", 1)
    + r""", n AS (
        SELECT l.log_id, l.line_no, l.line, coalesce(w.width, -1) AS width,
            regexp_matches(l.line, '^(?:(?:[A-Za-z]:)?[^:\r\n]+?\.(?:tex|sty|cls|clo|def|cfg|ltx|fd|aux|bbl|bst|toc|out)):(\d+):\s*(\S.*?)\s*$') OR regexp_matches(l.line, '^!\s*(\S.*?)\s*$') AS starts
        FROM l LEFT JOIN widths w USING (log_id)
    ), walk AS (
        SELECT log_id, line_no, length(line) AS size, true AS fresh FROM n WHERE line_no = 1
        UNION ALL
        SELECT n.log_id, n.line_no, CASE WHEN w.size = n.width AND NOT n.starts THEN w.size + length(n.line) ELSE length(n.line) END, NOT (w.size = n.width AND NOT n.starts)
        FROM walk w JOIN n ON n.log_id = w.log_id AND n.line_no = w.line_no + 1
    ) SELECT log_id, count(*) FILTER (fresh) AS lines, CAST(max(size) AS INTEGER) AS longest FROM walk GROUP BY log_id"""
)
