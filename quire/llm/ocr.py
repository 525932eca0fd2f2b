"""Problem 3: text of scanned pages repaired into readable paragraphs.

Stages, none of which moves whole texts but the last:

1. ``words``: one scan counts words; words broken at a line end are counted apart, joined. Combined per partition.
2. ``repairs``: symmetric-delete index. Each word gives its keys (one character or a confusion's side deleted, with the
   gap's place and strokes); words that share a key are candidates, a weighted edit distance with confusion pairs keeps
   those that differ by one misreading, and a candidate must be much more frequent than the word. Everything is joined by
   key on distinct words.
3. ``edges`` -> ``layout``: the first and last lines of each page meet those of the pages around it in blocks of pages
   (with a margin), so a pdf that holds a third of the pages is many small groups. Running titles are found by
   signatures that misreadings do not change, page numbers by the pdf's own offset, voted by all its pages.
4. ``items``: a second scan sends only line-end hyphens and words that are not in a bounded list of the most frequent
   sound words; all others are looked up in the distributed word table by joins, so the bound changes no result.
5. ``texts`` joins repairs to the texts once and writes paragraphs; among several candidates, of whole words and of words
   broken at a line or page end, the bigrams with the words beside it pick. ``found`` asks them where the candidates
   disagree about the line that holds the misreading.

Defined cases
-------------
* null or empty text: no lines, no cases, null text out. Repeated rows of an ocr_id give the same cases once; pages out
  once. Null pdf or page number: the page has no neighbours and is judged by itself.
* ties between candidates: lower cost, then higher count, then code point order.
* tokens of more than 64 characters are not words; in lines with ``=`` only tokens with three letters or more and no signs
  of a formula are words, the rest is the formula.
* two scans of one page number: both go on in the next page's first scan, neither in the other.
* a word broken at the end of a page goes on in the first body line of the next page number of its pdf that has text
  within four pages; if there is none, the part decides: a part that only begins compounds is no broken word.
* empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.cluster import cut, spread

BLOCK, MARGIN, EDGE = 64, 8, 3
RATIO = 8  # a repair is at least so many times as frequent as the word
KNOWN = 200_000  # sound words that a scan gets as a filter; the rest is looked up by join
LONGEST = 64
COUNTED = 1_000_000  # distinct words, or pairs of words, that a task counts before it hands the counts on
LONG = 300  # of a longer edge line only the ends are sent

HYPHENS = "-‐­¬‑"
#: Confusion pairs: printed -> read. Fixed values.
CONFUSIONS = """
e c | t + | i 1 | i ! | s 5 | n ri | o 0 | a @ | l 1 | u ii | m rn | h b | g 9 | v y | b 6 | li h | e f | t 7 | l i | i l
n r1 | n r! | z 2 | g q | b 8 | d cl | w vv | c e | h li | m nn | r n | o c | 0 o | s $ | a 4 | e 3 | ri n | rn m | q g | y v | b h | cl d
"""
PAIRS = {tuple(reversed(p.split())) for row in CONFUSIONS.strip().split("\n") for p in row.split("|")}
PAIRS = {(read, printed) for read, printed in PAIRS}
_STRIP = ".,;:()\"'[]{}“”‘’?"
_ODD = re.compile(r"[^\W\d_]")
_ODD_SIGN = re.compile(r"[^\w'’-]|[\d_]")
_HEADING = re.compile(r"^\s*\d{1,3}\.\d{1,3}\.?\s+\S")
_CLOSED = re.compile(r"[.,;:?!]$")


# --- words -------------------------------------------------------------------------------------------------------
def word_of(token: str) -> str | None:
    """The word in a token, in lower case; None if it is none."""
    w = token.strip(_STRIP).lower()
    return w if 2 <= len(w) <= LONGEST and _ODD.search(w) else None


def line_words(lines: list[str]) -> Iterator[tuple[int, list[str], str | None, int | None, str | None]]:
    """(line, its whole tokens, part before a line-end hyphen, next line, part after it) of each line with tokens.

    The tokens leave out the two parts of a word broken at a line end."""
    inner = [(k, t) for k, t in enumerate(map(str.split, lines)) if t]
    skip = False
    for j, (k, toks) in enumerate(inner):
        toks = toks[1:] if skip else toks
        skip = False
        left = right = after = None
        if toks and toks[-1][-1] in HYPHENS and len(toks[-1]) > 1 and toks[-1][-2].isalnum():
            left, toks = toks[-1][:-1], toks[:-1]
            if j + 1 < len(inner):
                after, right = inner[j + 1][0], inner[j + 1][1][0]
                skip = True
        yield k, toks, left, after, right


_FORMULA = re.compile(r"[^\w!|+@$'’-]|_")


def prose(token: str) -> bool:
    """Whether a token of a line with ``=`` is a word, misread or not, and no part of the formula."""
    core = token.strip(_STRIP)
    return sum(map(str.isalpha, core)) >= 3 and not _FORMULA.search(core)


def prose_of(line: str) -> str:
    """A line with ``=`` without its formula; the tokens at its ends may be parts of broken words. Empty if it is all formula."""
    toks = line.split()
    keep = [prose(t) for t in toks]
    return " ".join([t for j, t in enumerate(toks) if keep[j] or (j in (0, len(toks) - 1) and "=" not in t)]) if any(keep) else ""


def joined(left: str, right: str) -> str:
    return left.strip(_STRIP).lower() + right.strip(_STRIP).lower()


def count_words(texts: list[str | None]) -> tuple[Counter, Counter]:
    """Whole tokens and joined words of texts: all tokens are counted first, then the parts of broken words taken off."""
    whole: Counter = Counter()
    broken: Counter = Counter()
    parts: Counter = Counter()
    for text in texts:
        if not text:
            continue
        lines = text.split("\n")
        if "=" in text:
            lines = [prose_of(x) if "=" in x else x for x in lines]
            text = "\n".join(lines)
        whole.update(text.split())
        eaten = -1
        for k, line in enumerate(lines):
            s = line.rstrip()
            if not s or s[-1] not in HYPHENS or not s[-2:-1].isalnum():
                continue
            toks = s.split()
            if eaten == k and len(toks) == 1:
                continue
            parts[toks[-1]] += 1
            after = next((j for j in range(k + 1, len(lines)) if lines[j].strip()), None)
            if after is not None:
                right = lines[after].split(None, 1)[0]
                parts[right] += 1
                broken[joined(toks[-1][:-1], right)] += 1
                eaten = after
    whole.subtract(parts)
    return +whole, broken


def words(pages: DataFrame, tails: DataFrame | None = None) -> DataFrame:
    """(word, n, broken): how often a word stands whole, and joined from two lines; ``tails`` gives those joined from two
    pages, one row each."""

    def counts(whole: Counter, broken: Counter) -> pa.RecordBatch:
        total: dict[str, list[int]] = {}
        for source, at in ((whole, 0), (broken, 1)):
            for token, n in source.items():
                if (w := word_of(token)) is not None:
                    total.setdefault(w, [0, 0])[at] += n
        keys = list(total)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), pa.array([total[k][0] for k in keys], pa.int64()), pa.array([total[k][1] for k in keys], pa.int64())], ["word", "n", "broken"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: Counter = Counter()
        broken: Counter = Counter()
        for batch in batches:
            w, b = count_words(batch.column(0).to_pylist())
            whole.update(w)
            broken.update(b)
            if len(whole) + len(broken) > COUNTED:
                yield counts(whole, broken)
                whole, broken = Counter(), Counter()
        yield counts(whole, broken)

    parts = spread(pages.select("text")).mapInArrow(run, "word string, n bigint, broken bigint")
    if tails is not None:
        long = F.length("word").between(2, LONGEST) & F.col("word").rlike(r"\p{L}")
        parts = parts.unionByName(tails.where(long).select("word", F.lit(0).cast("bigint").alias("n"), F.lit(1).cast("bigint").alias("broken")))
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("broken").alias("broken"))


def bare_word(token: Column) -> Column:
    """A token without punctuation, lower case; empty for null."""
    return F.lower(F.regexp_replace(F.coalesce(token, F.lit("")), r"""^[.,;:()"'\[\]{}“”‘’?]+|[.,;:()"'\[\]{}“”‘’?]+$""", ""))


# --- symmetric deletes and weighted edit distance ------------------------------------------------------------------
_PARTS = {x for pair in PAIRS for x in pair}


def delete_keys(word: str) -> set[str]:
    """The word's keys: what is left of it when one character, or the one or two of a confusion pair's side, are deleted,
    with the gap's place and, of a confusion, the strokes of what stood there; and its collapsed form, for several
    misreadings. Words that share a key differ in that gap alone, so no key is common to all short words."""
    keys = {"\0" + collapsed(word)}
    for i in range(len(word)):
        keys.add(word[:i] + "\1" + word[i + 1 :])
        for part in {word[i : i + 1], word[i : i + 2]} & _PARTS:
            keys.add(word[:i] + "\2" + collapsed(part) + word[i + len(part) :])
    return keys


#: Confusable characters by their strokes: members of a confusion pair give the same strokes.
_STROKES = str.maketrans({
    **dict.fromkeys("1!|l", "i"), **dict.fromkeys("0o", "o"), **dict.fromkeys("5$s", "s"), **dict.fromkeys("+7t", "t"), **dict.fromkeys("@4a", "a"), **dict.fromkeys("9gq", "g"),
    **dict.fromkeys("cef3", "e"), "o": "e", "0": "e", "2": "z", **dict.fromkeys("vy", "v"), "w": "vv", **dict.fromkeys("hb68u", "ii"), "d": "ei", **dict.fromkeys("rnm", "r"),
})
_LEGS = re.compile("r[ri]+")


def collapsed(word: str) -> str:
    """The word with the members of each confusion pair made equal: misreadings of any number share it."""
    return _LEGS.sub("r", word.translate(_STROKES))


def several(read: str, printed: str) -> tuple[float, int] | None:
    """(cost, position of the first) if ``read`` is ``printed`` with two or three misreadings by confusion pairs."""
    n, m = len(read), len(printed)
    best: dict[tuple[int, int], tuple[int, int]] = {(0, 0): (0, -1)}
    for total in range(n + m + 1):
        for i in range(max(0, total - m), min(n, total) + 1):
            j = total - i
            got = best.get((i, j))
            if got is None or got[0] > 3:
                continue
            steps = [((1, 1), 0)] if i < n and j < m and read[i] == printed[j] else []
            steps += [((a, b), 1) for a in (1, 2) for b in (1, 2) if (read[i : i + a], printed[j : j + b]) in PAIRS]
            for (a, b), c in steps:
                new = (got[0] + c, got[1] if got[1] >= 0 or not c else i)
                if (i + a, j + b) not in best or new < best[(i + a, j + b)]:
                    best[(i + a, j + b)] = new
    end = best.get((n, m))
    return (0.2 * end[0], end[1]) if end and 1 <= end[0] <= 3 else None


def misreading(read: str, printed: str) -> tuple[float, int] | None:
    """(cost, position) if ``read`` is ``printed`` with one misreading: 0.2 for a confusion pair, 1 for a sign or digit
    in place of a letter; None for anything else."""
    i, m = 0, min(len(read), len(printed))
    while i < m and read[i] == printed[i]:
        i += 1
    j = 0
    while j < m - i and read[-1 - j] == printed[-1 - j]:
        j += 1
    best = None
    # equal neighbours let the differing part slide; look at every placing of up to two characters
    for a in range(max(0, i - 1), i + 1):
        for b in range(max(0, j - 1), j + 1):
            x, y = read[a : len(read) - b], printed[a : len(printed) - b]
            if (x, y) in PAIRS:
                return 0.2, a
            if len(x) == len(y) == 1 and not x.isalpha() and y.isalpha():
                best = (1.0, a)
    return best


def repairs(table: DataFrame) -> DataFrame:
    """(word, repair, n_repair, cost, at): candidates of each word that may be a misreading, from the word table."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                printed = n > 0 and not _ODD_SIGN.search(w)  # a repair is a word of letters that stands whole somewhere
                for k in delete_keys(w):
                    # a gap of any character can only be read where a sign or digit stands in it
                    gap = k.find("\1")
                    read = gap < 0 or not w[gap].isalpha()
                    if read or printed:
                        for c, v in zip(out, (k, w, n, read, printed)):
                            c.append(v)
            kinds = (pa.string(), pa.string(), pa.int64(), pa.bool_(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], ["key", "word", "n", "read", "printed"])

    index = table.select("word", "n").mapInArrow(keys, "key string, word string, n bigint, read boolean, printed boolean")
    good = index.where("printed").select("key", F.col("word").alias("repair"), F.col("n").alias("n_repair"))
    odd = F.col("word").rlike(r"[^\p{L}'’-]")
    near = index.where("read").select("key", "word", "n").join(good, "key")
    near = near.where((F.col("word") != F.col("repair")) & (F.col("n_repair") >= F.when(odd, F.col("n") + 1).otherwise(RATIO * F.greatest("n", F.lit(1)))))
    near = near.select("word", "repair", "n_repair").distinct()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cost = [misreading(w, r) or several(w, r) for w, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            keep = pa.array([c is not None for c in cost])
            kept = [c for c in cost if c is not None]
            b = batch.filter(keep)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([c for c, _ in kept], pa.float64()), pa.array([p for _, p in kept], pa.int32())], ["word", "repair", "n_repair", "cost", "at"])

    return near.mapInArrow(weigh, "word string, repair string, n_repair bigint, cost double, at int")


def judged_words(table: DataFrame) -> DataFrame:
    """The word table with each word's best repair (null for a sound word) and all its candidates with the place they repair."""
    cand = repairs(table).groupBy("word").agg(
        F.min(F.struct("cost", (-F.col("n_repair")).alias("m"), "repair", "at")).alias("b"), F.collect_set(F.struct("repair", "at")).alias("candidates")
    )
    out = table.join(cand, "word", "left")
    return out.select("word", "n", "broken", F.col("b.repair").alias("repair"), (-F.col("b.m")).alias("n_repair"), F.col("b.at").alias("at"), "candidates")


# --- layout: running titles and page numbers -------------------------------------------------------------------------
_ROMAN = re.compile(r"^m{0,3}(?:cm|cd|d?c{0,3})(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})$")
_ORNAMENT = re.compile(r"^[\W_]*(?:p(?:age|ag|g|p)?\b\.?)?[\W_]*|[\W_]*$", re.I)
_DIGITS = str.maketrans("lIi!|oOQsSBbgqzZ+", "11111000558699227")
_LETTERS = str.maketrans("1!|0563@+7894", "iiiosbeattbga")
_MANY = (("li", "h"), ("rn", "m"), ("ri", "n"), ("ii", "u"), ("cl", "d"), ("vv", "w"))
_ONE = str.maketrans("lchyfq", "iebveg")


def roman(s: str) -> int | None:
    if not s or not _ROMAN.match(s):
        return None
    value = {"i": 1, "v": 5, "x": 10, "l": 50, "c": 100, "d": 500, "m": 1000}
    v = [value[c] for c in s]
    return sum(-a if a < b else a for a, b in zip(v, [*v[1:], 0]))


_NUMERIC = re.compile(r"[\W_]*[0-9a-zA-Z!|+@]{1,9}[\W_]*")
_NO_NUMBER = re.compile(r"[aefhjknprtuwyAC-HJKNPRTUWY]")


@lru_cache(maxsize=200_000)
def numbers(token: str) -> list[tuple[str, int]]:
    """What a token may say as a page number, as (kind, value): as it stands, then with misread digits."""
    if not _NUMERIC.fullmatch(token) or (_NO_NUMBER.search(token) and not any(c.isdigit() for c in token)):
        return []
    bare = token.strip("-–—·~[]().,* ")
    t = bare.lower()
    out = []
    if t.isascii() and t.isdigit() and len(t) < 7:
        out.append(("a", int(t)))
    elif t and len(t) < 10:
        if (r := roman(t)) is not None:
            out.append(("r", r))
        elif (r := roman(t.translate(str.maketrans("1!|y7", "iiivv")))) is not None:
            out.append(("r", r))
        d = bare.translate(_DIGITS)
        if (any(c.isdigit() for c in t) or set(bare) <= set("lI|OBSZ")) and d.isascii() and d.isdigit() and len(d) < 7:
            out.append(("a", int(d)))
    return out


_NO_LETTER = re.compile(r"[\W\d_]+")


@lru_cache(maxsize=200_000)
def signature(text: str) -> str:
    """Letters of a title as misreadings, letter spacing and case leave them."""
    toks = text.split()
    if len(toks) > 3 and sum(len(t) == 1 for t in toks) > 0.6 * len(toks):
        toks = ["".join(toks)]
    s = _NO_LETTER.sub("", "".join([t for t in toks if not t.isdigit()]).translate(_LETTERS).lower())
    for a, b in _MANY:
        s = s.replace(a, b)
    return s.replace("r", "n").translate(_ONE)


def edge_line(line: str) -> str:
    """The line; of a long one both ends, whole to the first and from the last token that may be a number, and a stand-in
    for what lies between, which is no title, no number, and a formula if the line is one."""
    t = line.rstrip()
    if len(t) < LONG:
        return t
    h = _ORNAMENT.match(t).end()
    while h < len(t) and not t[h].isspace():
        h += 1
    e = len(t)
    while e and not t[e - 1].isalnum():
        e -= 1
    b = e
    while b and not t[b - 1].isspace():
        b -= 1
    return t if b <= h else t[:h] + " " + ("=" if "=" in t[h:b] else "") + "x" * LONG + " " + t[b:]


def page_edges(text: str) -> tuple[list, list, list, int]:
    """(first lines, last lines, headings further in, width): lines as (line number, text, blank before, blank after)."""
    lines = text.split("\n")
    bare = [x.strip() for x in lines]
    full = [k for k, x in enumerate(bare) if x]
    width = sorted(map(len, lines))[-max(1, len(lines) // 4)] if lines else 0

    def row(k: int) -> tuple[int, str, bool, bool]:
        return k + 1, edge_line(lines[k]), k == 0 or not bare[k - 1], k + 1 >= len(lines) or not bare[k + 1]

    top = full[:EDGE]
    bottom = [k for k in full[-EDGE:] if k not in top]
    heads = [(k + 1, bare[k]) for k in full[1:] if bare[k][0].isdigit() and len(lines[k]) < 120 and _HEADING.match(lines[k])]
    return [row(k) for k in top], [row(k) for k in bottom], heads, width


def edges(pages: DataFrame) -> DataFrame:
    """(ocr_id, pdf, page_num, votes, edge): each page's edge lines as JSON, and the offsets its numbers vote for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, pdfs, nums, votes, edge = [], [], [], [], []
            for i, pdf, page, text in zip(*[c.to_pylist() for c in batch.columns]):
                if not text or not text.strip():
                    continue
                top, bottom, heads, width = page_edges(text)
                seen, alone = [], []
                if page is not None:
                    for k, t, _, _ in [*top[:2], *bottom[-2:]]:
                        core = _ORNAMENT.sub("", t)
                        toks = core.split()
                        for tok in {toks[0], toks[-1]} if toks else ():
                            seen += [f"{kind}{page - v}" for kind, v in numbers(tok)[:1]]
                            alone += seen[-1:] if len(toks) == 1 and numbers(tok) else []  # a line of its own counts twice
                ids.append(i)
                pdfs.append(pdf)
                nums.append(page)
                votes.append([*dict.fromkeys(seen), *dict.fromkeys(alone)])
                edge.append(json.dumps([i, page, top, bottom, heads, width], ensure_ascii=False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(pdfs, pa.string()), pa.array(nums, pa.int32()), pa.array(votes, pa.list_(pa.string())), pa.array(edge, pa.string())],
                ["ocr_id", "pdf", "page_num", "votes", "edge"],
            )

    return spread(pages.select("ocr_id", "pdf", "page_num", "text")).mapInArrow(run, "ocr_id bigint, pdf string, page_num int, votes array<string>, edge string")


def _title_like(t: str, width: int) -> bool:
    s = t.strip()
    words_ = s.split()
    return bool(s) and not _CLOSED.search(s) and s[-1] not in HYPHENS and "=" not in s and len(words_) <= 7 and "," not in s and (s[0].isupper() or s[0].isdigit()) and len(s) <= 0.85 * max(width, 30)


def _caps(t: str) -> bool:
    upper = sum(map(str.isupper, t))
    return upper > 3 and upper >= 0.8 * max(4, sum(map(str.isalpha, t)))


class Sheet:
    """One page's edges and what is found of them."""

    __slots__ = ("ocr_id", "page", "top", "bottom", "heads", "width", "drop", "sigs", "first", "last")

    def __init__(self, row: list) -> None:
        self.ocr_id, self.page, self.top, self.bottom, self.heads, self.width = row
        self.drop: dict[int, str] = {}
        self.sigs: dict[int, str] = {}
        self.first: tuple | None = None
        self.last: tuple | None = None


def lay_out(rows: list[list], offsets: dict[str, int], titles: list[tuple[str, int | None]]) -> list[Sheet]:
    """Running titles and page numbers of the pages of one block. ``titles``: (title, page on which its section begins,
    or null for a chapter's title)."""
    sheets = [Sheet(r) for r in rows]
    known = {signature(t) for t, _ in titles if t} | {signature("Contents"), signature("Preface")}
    opens = {(p, signature(t)) for t, p in titles if t and p is not None}

    def own(sheet: Sheet, token: str) -> bool:
        return sheet.page is not None and any(offsets.get(kind) == sheet.page - v for kind, v in numbers(token))

    def bare(sheet: Sheet, t: str) -> tuple[str, bool]:
        """The title without the page's own number, and whether that stood in it."""
        toks = t.split()
        for at in (0, -1):
            if len(toks) > 1 and own(sheet, toks[at]):
                core = " ".join(toks[1:] if at == 0 else toks[:-1])
                if not _CLOSED.search(core):  # "no. 7" on page 7 is the title's own
                    return core, True
        return t.strip(), False

    # signatures of edge lines by page, to look for the same title on pages around
    seen: dict[str, set[tuple[int, str]]] = {}
    for s in sheets:
        for slot, lines in (("top", s.top), ("bottom", s.bottom)):
            for k, t, _, _ in lines[:2] if slot == "top" else lines[-3:]:
                core, _ = bare(s, t)
                if len(t) >= 200 or _CLOSED.search(core) or core[-1:] in HYPHENS:
                    continue  # no title ends like that
                sig = signature(core)
                s.sigs[k] = sig
                if len(sig) >= 4 and s.page is not None:
                    seen.setdefault(sig, set()).add((s.page, slot))
    inside: dict[str, set[int]] = {}
    for s in sheets:
        for k, t in s.heads:
            if s.page is not None:
                inside.setdefault(signature(t), set()).add(s.page)

    def is_number(s: Sheet, t: str) -> bool:
        core = _ORNAMENT.sub("", t)
        return bool(core) and " " not in core and own(s, core)

    at_page: dict[int, Sheet] = {}

    def open_end(s: Sheet) -> bool:
        """Whether the page before ends inside a sentence."""
        before = at_page.get(s.page - 1) if s.page is not None else None
        return before is not None and before.last is not None and "=" not in before.last[1] and not re.search(r"[.!?:)\]]$|\d$", before.last[1])

    def is_title(s: Sheet, k: int, t: str, slot: str, before: bool, after: bool) -> bool:
        if len(t) >= 200 or "=" in t:
            return False
        core, numbered = bare(s, t)
        if _CLOSED.search(core) or core[-1:] in HYPHENS:
            return False
        sig = s.sigs.get(k) or signature(core)
        if len(sig) < 3:
            return False
        near = any(p != s.page and sl == slot and abs(p - s.page) <= MARGIN for p, sl in seen.get(sig, ())) if s.page is not None else False
        plain = _HEADING.match(core) and not numbered and not _caps(core)
        if slot == "top" and plain and k == s.top[0][0]:
            title = signature(core)
            if any(signature(h) == title for j, h in s.heads if j != k):
                return True  # the heading itself stands further down
            if core.lstrip().startswith("0") or not after or open_end(s):
                return True  # front matter; no blank after it; the page before ends inside a sentence
            if (s.page, title) in opens:
                return False
            # named before, or known to begin elsewhere: a running title; else the page opens the section
            return any(s.page is not None and p < s.page for p in inside.get(title, ())) or any(
                sl == "top" and s.page is not None and p < s.page for p, sl in seen.get(title, ())
            ) or any(t2 == title for _, t2 in opens)
        if numbered and (near or _title_like(core, s.width) or sig in known):
            return True
        if _caps(core) and len(core.split()) <= 40:
            return True
        if sig in known:
            return True
        if near and (_title_like(core, 1.4 * s.width) or slot == "bottom"):
            return True
        if slot != "top" or k != s.top[0][0] or not _title_like(core, s.width) or _HEADING.match(core):
            return False
        # seen once: a title if the sentence of the page before goes on below it, or if no sentence goes on from it
        return open_end(s) or after or not (len(s.top) > 1 and s.top[1][1].lstrip()[:1].islower())

    for s in sheets:
        both = bool(s.bottom) or len(s.top) > 1
        got: set[str] = set()
        for k, t, before, after in s.top[:3]:
            kind = "page_number" if is_number(s, t) else "header" if is_title(s, k, t, "top", before, after) else None
            if kind is None or kind in got or not both:
                break
            got.add(kind)
            s.drop[k] = kind
        got = set()
        lines = [*s.top, *s.bottom]
        for k, t, before, after in reversed(lines[-3:]):
            if k in s.drop:
                break
            kind = "page_number" if is_number(s, t) else "header" if is_title(s, k, t, "bottom", before, after) else None
            if kind is None or kind in got:
                break
            got.add(kind)
            s.drop[k] = kind
        body = [x for x in lines if x[0] not in s.drop]
        top_body = [x for x in body if x in s.top] or body[:1]
        s.first = top_body[0] if top_body else None
        s.last = body[-1] if body else None
        if s.page is not None:
            at_page[s.page] = s
    return sheets


def layout(pages: DataFrame, sections: DataFrame, chapters: DataFrame) -> DataFrame:
    """(ocr_id, drop, tail): the lines that are no body, as ``map<line_no, kind>``, and the word broken at the page's
    end: (line_no, left, next_ocr_id, next_line_no, right)."""
    e = cut(edges(pages))
    blk = F.coalesce(F.floor(F.col("page_num") / BLOCK), F.floor(F.col("ocr_id") / BLOCK))
    votes = e.where("pdf is not null").select("pdf", F.explode("votes").alias("v")).groupBy("pdf", "v").agg(F.count("*").alias("c"))
    votes = votes.groupBy("pdf", F.substring("v", 1, 1).alias("kind")).agg(F.max_by("v", F.struct("c", "v")).alias("v"), F.max("c").alias("c"))
    offsets = votes.where("c >= 2").groupBy("pdf").agg(F.collect_list("v").alias("offsets"))  # at most two: arabic and roman

    margin = F.array_distinct(F.array(blk, F.floor((F.col("page_num") - MARGIN) / BLOCK), F.floor((F.col("page_num") + MARGIN) / BLOCK)))
    halo = e.where("pdf is not null").select("pdf", "edge", blk.alias("own"), F.explode(F.filter(margin, lambda x: x.isNotNull())).alias("blk"))
    blocks = halo.groupBy("pdf", "blk").agg(F.collect_set(F.struct((F.col("own") == F.col("blk")).alias("mine"), "edge")).alias("rows"))

    pdf = F.concat(F.lit("pdfs/"), F.col("book"), F.lit(".pdf")).alias("pdf")
    named = sections.where("book is not null and title is not null and page_no is not null and chapter is not null").select(
        pdf, F.struct("title", F.col("page_no").alias("page")).alias("t"), F.floor(F.col("page_no") / BLOCK).alias("b0")
    )
    named = named.select("pdf", "t", F.explode(F.array("b0", F.col("b0") + 1)).alias("blk"))
    ranges = chapters.where("book is not null and title is not null and start_page is not null and end_page >= start_page").select(
        pdf, F.struct("title", F.lit(None).cast("int").alias("page")).alias("t"), F.floor(F.col("start_page") / BLOCK).alias("b0"), F.floor(F.col("end_page") / BLOCK).alias("b1")
    )
    # blocks that hold pages, of the chapter's pdf: a chapter's last page may be anything
    held = halo.groupBy("pdf", "blk").agg(F.count("*").alias("n")).select("pdf", "blk")
    ranges = ranges.join(held, "pdf").where("blk between b0 and b1").select("pdf", "t", "blk")
    titles = named.unionByName(ranges).distinct().groupBy("pdf", "blk").agg(F.collect_list("t").alias("titles"))
    blocks = blocks.join(offsets, "pdf", "left").join(titles, ["pdf", "blk"], "left").select("rows", "offsets", "titles")
    # without a pdf a page is a group of its own; no offsets or titles are known of it
    lone = e.where("pdf is null").groupBy("ocr_id").agg(F.collect_set(F.struct(F.lit(True).alias("mine"), "edge")).alias("rows"))
    blocks = blocks.unionByName(lone.select("rows"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, drops, tails = [], [], []
            for rows, offs, tts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                mine, parsed = set(), {}
                for r in rows:
                    row = json.loads(r["edge"])
                    parsed[row[0]] = row
                    if r["mine"]:
                        mine.add(row[0])
                order = sorted(parsed.values(), key=lambda x: (x[1] is None, x[1] or 0, x[0]))
                sheets = lay_out(order, {v[0]: int(v[1:]) for v in offs or ()}, [(t["title"], t["page"]) for t in tts or ()])
                nexts: list[Sheet | None] = [None] * len(sheets)
                for k in range(len(sheets) - 2, -1, -1):  # a second scan of the same page is no next page: its next one is this one's
                    same = sheets[k].page is not None and sheets[k + 1].page == sheets[k].page
                    nexts[k] = nexts[k + 1] if same else sheets[k + 1]
                for s, follow in zip(sheets, nexts):
                    if s.ocr_id not in mine:
                        continue
                    tail = None
                    if s.last is not None:
                        toks = s.last[1].split()
                        if toks and toks[-1][-1] in HYPHENS and len(toks[-1]) > 1 and toks[-1][-2].isalnum():
                            tail = {"line_no": s.last[0], "left": toks[-1][:-1], "next_id": None, "next_line": None, "right": None, "prev": word_of(toks[-2]) if len(toks) > 1 else None, "follow": None}
                            if follow is not None and follow.first is not None and s.page is not None and follow.page is not None and 0 < follow.page - s.page <= 4:
                                there = follow.first[1].split()
                                tail |= {"next_id": follow.ocr_id, "next_line": follow.first[0], "right": there[0], "follow": word_of(there[1]) if len(there) > 1 else None}
                    ids.append(s.ocr_id)
                    drops.append(list(s.drop.items()))
                    tails.append(tail)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(drops, pa.map_(pa.int32(), pa.string())), pa.array(tails, _TAIL)], ["ocr_id", "drop", "tail"])

    return blocks.mapInArrow(
        run, "ocr_id bigint, drop map<int,string>, tail struct<line_no:int,left:string,next_id:bigint,next_line:int,right:string,prev:string,follow:string>"
    )


_TAIL = pa.struct([("line_no", pa.int32()), ("left", pa.string()), ("next_id", pa.int64()), ("next_line", pa.int32()), ("right", pa.string()), ("prev", pa.string()), ("follow", pa.string())])


# --- items: what a scan sends to be looked up ------------------------------------------------------------------------
def items(pages: DataFrame, known: list[str]) -> DataFrame:
    """(ocr_id, line_no, next_line, word, lft, rgt, prev, follow): hyphens at line ends (``lft`` set) and words not known."""
    shared = pages.sparkSession.sparkContext.broadcast(frozenset(known))  # at most KNOWN words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sound = shared.value
        plain: set[str] = set()  # tokens that need no look-up
        for batch in batches:
            out: list[tuple] = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                lines = text.split("\n")
                for k, toks, left, after, right in line_words(lines):
                    if left is not None and right is not None:
                        beyond = lines[after].split(None, 2)[1:2]
                        beside = (word_of(toks[-1]) if toks else None, word_of(beyond[0]) if beyond else None)
                        out.append((i, k + 1, after + 1, joined(left, right), left.strip(_STRIP).lower(), right.strip(_STRIP).lower(), *beside))
                    if plain.issuperset(toks):
                        continue
                    formula = "=" in lines[k]
                    for j, tok in enumerate(toks):
                        if tok in plain or (formula and not prose(tok)):
                            continue
                        w = word_of(tok)
                        if w is None or w in sound:
                            plain.add(tok)
                            continue
                        before = word_of(toks[j - 1]) if j else None
                        out.append((i, k + 1, None, w, None, None, before, word_of(toks[j + 1]) if j + 1 < len(toks) else None))
                if len(plain) > 500_000:
                    plain.clear()
            cols = list(zip(*out)) if out else [[]] * 8
            kinds = (pa.int64(), pa.int32(), pa.int32(), *[pa.string()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["ocr_id", "line_no", "next_line", "word", "lft", "rgt", "prev", "follow"])

    return spread(pages.select("ocr_id", "text")).mapInArrow(
        run, "ocr_id bigint, line_no int, next_line int, word string, lft string, rgt string, prev string, follow string"
    )


class Repair:
    """The tables all results are made of, each built once."""

    def __init__(self, pages: DataFrame, sections: DataFrame, chapters: DataFrame) -> None:
        self.pages = pages.select("ocr_id", "pdf", "page_num", "text")
        self.layout = cut(layout(self.pages, sections, chapters))
        tails = self.layout.where("tail.right is not null").select(F.concat(bare_word(F.col("tail.left")), bare_word(F.col("tail.right"))).alias("word"))
        self.table = cut(judged_words(cut(words(self.pages, tails))))
        known = [r.word for r in self.table.where("repair is null and n > 0").orderBy(F.desc("n"), "word").limit(KNOWN).select("word").collect()]
        self.items = cut(items(self.pages, known))

    def breaks(self) -> DataFrame:
        """Every word broken at a line end between body lines, judged: hyphen or compound, its misreading by cost and count
        (``fix``, which repairs place ``fix_at``) and all candidates for it."""
        lay = self.layout.select("ocr_id", "drop", "tail")
        inner = self.items.where("lft is not null").join(lay, "ocr_id")
        inner = inner.where("not coalesce(map_contains_key(drop, line_no) or map_contains_key(drop, next_line), false)").select(
            "ocr_id", "line_no", F.col("ocr_id").alias("next_id"), "next_line", "word", "lft", "rgt", "prev", "follow"
        )
        ends = lay.where("tail is not null").select(
            "ocr_id", "tail.line_no", "tail.next_id", "tail.next_line", F.concat(bare_word(F.col("tail.left")), bare_word(F.col("tail.right"))).alias("word"), bare_word(F.col("tail.left")).alias("lft"),
            F.when(F.col("tail.right").isNotNull(), bare_word(F.col("tail.right"))).alias("rgt"), "tail.prev", "tail.follow",
        )
        # a page's last body line is judged by its tail alone
        inner = inner.join(ends.select("ocr_id", "line_no"), ["ocr_id", "line_no"], "left_anti")
        both = inner.unionByName(ends).withColumn("compound", F.concat_ws("-", "lft", "rgt"))
        t = self.table.select("word", "n", "repair", "n_repair", "at", "candidates")
        both = both.join(t, "word", "left").withColumn("n_word", F.when(F.col("repair").isNull(), F.coalesce("n", F.lit(0))).otherwise(F.col("n_repair")))
        c = t.select(F.col("word").alias("compound"), F.coalesce(F.when(F.col("repair").isNull(), F.col("n")).otherwise(F.col("n_repair")), F.lit(0)).alias("n_comp"), F.col("repair").alias("c_repair"), F.col("at").alias("c_at"), F.col("candidates").alias("c_candidates"))
        both = both.join(c, "compound", "left").fillna(0, ["n_word", "n_comp"])
        first = self.table.where("repair is null and n > 0").select(F.regexp_extract("word", r"^([^-]+)-\p{L}", 1).alias("lft"), "n").where("lft <> ''").groupBy("lft").agg(F.sum("n").alias("n_first"))
        both = both.join(first, "lft", "left").fillna(0, ["n_first"])
        hyphen = (
            F.when(F.col("rgt").isNull(), (F.col("n_first") == 0) & F.col("lft").rlike(r"^\p{L}"))
            .when(~F.col("rgt").rlike(r"^[\p{L}0-9@!+]"), False)
            .when((F.col("n_word") > 0) | (F.col("n_comp") > 0), F.col("n_word") > F.col("n_comp"))
            .otherwise(F.col("n_first") == 0)
        )
        both = both.withColumn("hyphen", hyphen)
        either = lambda a, b: F.when(F.col("hyphen"), F.col(a)).otherwise(F.col(b))
        # the left part holds the places below its length; a compound's own hyphen is on its line, too
        own = F.length("lft") + F.when(F.col("hyphen"), 0).otherwise(1)
        return both.select(
            "ocr_id", "line_no", "next_id", "next_line", "rgt", "hyphen", "prev", "follow", either("word", "compound").alias("word"), either("repair", "c_repair").alias("fix"), either("at", "c_at").alias("fix_at"),
            either("candidates", "c_candidates").alias("candidates"), own.alias("own"),
        )

    def read_breaks(self, lines_only: bool) -> DataFrame:
        """``breaks`` with the candidate that the words beside it pick. With ``lines_only`` only where candidates disagree
        about the line that holds the misreading: the others name the same case."""
        br = cut(self.breaks().distinct())
        many = F.size(F.coalesce("candidates", F.array())) > 1
        if lines_only:
            many = many & F.exists("candidates", lambda x: x["at"] < F.col("own")) & F.exists("candidates", lambda x: x["at"] >= F.col("own"))
        got = self.pick(br.where(many).select("ocr_id", "line_no", "word", F.col("fix").alias("repair"), "candidates", "prev", "follow"))
        got = got.select("ocr_id", "line_no", F.col("repair").alias("picked"), F.col("at").alias("picked_at"))
        br = br.join(got, ["ocr_id", "line_no"], "left")
        return br.withColumn("fix", F.coalesce("picked", "fix")).withColumn("fix_at", F.coalesce("picked_at", "fix_at")).drop("picked", "picked_at", "candidates")

    def misread_words(self) -> DataFrame:
        """Every misread whole word in a body line: (ocr_id, line_no, word, repair, candidates, prev, follow)."""
        lone = self.items.where("lft is null").join(self.table.where("repair is not null").select("word", "repair", "candidates"), "word")
        return lone.join(self.layout.select("ocr_id", "drop"), "ocr_id").where("not coalesce(map_contains_key(drop, line_no), false)").drop("drop")

    def found(self) -> DataFrame:
        lines = self.layout.select("ocr_id", F.explode("drop").alias("line_no", "kind"))
        bad, left = F.col("fix").isNotNull(), F.col("fix_at") < F.col("own")
        here, there = F.struct(F.col("ocr_id"), F.col("line_no"), F.lit("misread").alias("kind")), F.struct(F.col("next_id").alias("ocr_id"), F.col("next_line").alias("line_no"), F.lit("misread").alias("kind"))
        case = F.array_compact(F.array(F.when(F.col("hyphen"), F.struct("ocr_id", "line_no", F.lit("hyphen").alias("kind"))), F.when(bad & left, here).when(bad & F.col("next_id").isNotNull(), there)))
        cases = self.read_breaks(lines_only=True).select(F.explode(case).alias("c")).select("c.*")
        words_ = self.misread_words().select("ocr_id", "line_no", F.lit("misread").alias("kind"))
        return lines.unionByName(cases).unionByName(words_).where("ocr_id is not null").distinct()

    # --- texts ---
    def bigrams(self, wanted: list[tuple[str, str]] | None) -> DataFrame:
        """(a, b, n) of neighbouring words of a page, lower case and without punctuation; with ``wanted`` only these pairs."""
        shared = self.pages.sparkSession.sparkContext.broadcast(None if wanted is None else frozenset(wanted))  # at most KNOWN pairs

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keep, total = shared.value, Counter()
            bare = str.maketrans("", "", _STRIP)

            def counts() -> pa.RecordBatch:
                keys = list(total)
                return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(total.values()), pa.int64())], ["a", "b", "n"])

            for batch in batches:
                if len(total) > COUNTED:
                    yield counts()
                    total.clear()
                for text in batch.column(0).to_pylist():
                    if not text:
                        continue
                    seen = text.lower().translate(bare).split()
                    if keep is None:
                        total.update(zip(seen, seen[1:]))
                    elif got := keep.intersection(zip(seen, seen[1:])):
                        total.update([x for x in zip(seen, seen[1:]) if x in got])
            yield counts()

        parts = spread(self.pages.select("text")).mapInArrow(run, "a string, b string, n bigint")
        return parts.groupBy("a", "b").agg(F.sum("n").alias("n"))

    def pick(self, rows: DataFrame) -> DataFrame:
        """(ocr_id, line_no, word, repair, at): of each row's candidates the one that stands most often beside the row's
        neighbours; without any such pair the best by cost and count."""
        many = cut(rows.select("*", F.explode("candidates").alias("c")).select("ocr_id", "line_no", "word", "prev", "follow", "repair", F.col("c.repair").alias("c"), F.col("c.at").alias("at")))
        beside = F.explode(F.array(F.struct(F.col("prev").alias("a"), F.col("c").alias("b")), F.struct(F.col("c").alias("a"), F.col("follow").alias("b"))))
        beside = many.select(beside.alias("p")).where("p.a is not null and p.b is not null").select("p.a", "p.b").distinct()
        # a filter of bounded size; beyond it all pairs are counted, with the same result
        wanted = [(r.a, r.b) for r in beside.limit(KNOWN + 1).collect()]
        if not wanted:  # nothing to pick by, nothing to count
            best = many.groupBy("ocr_id", "line_no", "word").agg(F.max_by(F.struct("c", "at"), F.struct(F.col("c") == F.col("repair"), "c")).alias("x"))
            return best.select("ocr_id", "line_no", "word", F.col("x.c").alias("repair"), F.col("x.at").alias("at"))
        pairs = self.bigrams(wanted if len(wanted) <= KNOWN else None)
        many = many.join(pairs.select(F.col("a").alias("prev"), F.col("b").alias("c"), F.col("n").alias("n1")), ["prev", "c"], "left")
        many = many.join(pairs.select(F.col("a").alias("c"), F.col("b").alias("follow"), F.col("n").alias("n2")), ["c", "follow"], "left")
        score = F.log1p(F.coalesce("n1", F.lit(0))) + F.log1p(F.coalesce("n2", F.lit(0)))
        best = many.groupBy("ocr_id", "line_no", "word").agg(F.max_by(F.struct("c", "at"), F.struct(score, F.col("c") == F.col("repair"), "c")).alias("x"))
        return best.select("ocr_id", "line_no", "word", F.col("x.c").alias("repair"), F.col("x.at").alias("at"))

    def picked(self) -> tuple[DataFrame, DataFrame]:
        """(misread whole words with the repair picked, broken words likewise): one count of pairs serves both."""
        bad = cut(self.misread_words().distinct())
        br = cut(self.breaks().distinct())
        one = bad.where(F.size("candidates") < 2).select("ocr_id", "line_no", "word", "repair")
        cols = ["ocr_id", "line_no", "word", "repair", "candidates", "prev", "follow"]
        many = F.size(F.coalesce("candidates", F.array())) > 1
        # the line's number tells the two apart: negative for broken words
        rows = bad.where(many).select(*cols).unionByName(br.where(many).select("ocr_id", (-F.col("line_no")).alias("line_no"), "word", F.col("fix").alias("repair"), *cols[4:]))
        got = cut(self.pick(rows))
        words_ = one.unionByName(got.where("line_no > 0").drop("at"))
        fixed = got.where("line_no < 0").select("ocr_id", (-F.col("line_no")).alias("line_no"), F.col("repair").alias("picked"))
        return words_, br.join(fixed, ["ocr_id", "line_no"], "left").withColumn("fix", F.coalesce("picked", "fix"))

    def texts(self) -> DataFrame:
        """(ocr_id, pdf, page_num, paragraphs, text): body paragraphs of each page; a word broken at the page's end stands
        whole here and is left out of the next page."""
        words_, br = self.picked()
        note = lambda *c: F.struct(*[x.alias(n) for x, n in zip(c, ("line_no", "kind", "a", "b"))])
        none = F.lit(None).cast("string")
        ends = self.layout.where("tail is not null and tail.right is not null").select("ocr_id", F.col("tail.line_no").alias("line_no"), F.col("tail.right").alias("raw"))
        raw = br.join(ends, ["ocr_id", "line_no"], "left")
        notes = (
            self.layout.select("ocr_id", F.explode("drop").alias("line_no", "kind")).select("ocr_id", note(F.col("line_no"), F.lit("drop"), none, none).alias("x"))
            .unionByName(words_.select("ocr_id", note(F.col("line_no"), F.lit("word"), F.col("word"), F.col("repair")).alias("x")))
            .unionByName(raw.where("rgt is not null").select("ocr_id", note(F.col("line_no"), F.when(F.col("hyphen"), "join").otherwise("compound"), F.col("fix"), F.col("raw")).alias("x")))
            .unionByName(raw.where("raw is not null and next_id is not null").select(F.col("next_id").alias("ocr_id"), note(F.col("next_line"), F.lit("eaten"), none, none).alias("x")))
        )
        notes = notes.groupBy("ocr_id").agg(F.collect_set("x").alias("notes"))
        one = self.pages.groupBy("ocr_id").agg(F.max(F.struct("text", "pdf", "page_num")).alias("p"))
        rows = one.join(notes, "ocr_id", "left").select("ocr_id", "p.pdf", "p.page_num", "p.text", "notes")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                paras = [None if t is None else paragraphs(t, n or []) for t, n in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
                text = [None if p is None else "\n\n".join(p) for p in paras]
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(paras, pa.list_(pa.string())), pa.array(text, pa.string())], ["ocr_id", "pdf", "page_num", "paragraphs", "text"])

        return rows.mapInArrow(run, "ocr_id bigint, pdf string, page_num int, paragraphs array<string>, text string")


def _as(repair: str, token: str) -> str:
    """The repair in the token's case, with the token's punctuation around it."""
    core = token.strip(_STRIP)
    at = token.find(core)
    letters = [c for c in core if c.isalpha()]
    word = repair.upper() if len(letters) > 1 and all(c.isupper() for c in letters) else repair[:1].upper() + repair[1:] if core[:1].isupper() else repair
    return token[:at] + word + token[at + len(core) :]


def paragraphs(text: str, notes: list[dict]) -> list[str]:
    """A page's body as paragraphs, by the notes on its lines."""
    by: dict[int, dict[str, list]] = {}
    for n in notes:
        by.setdefault(n["line_no"], {}).setdefault(n["kind"], []).append((n["a"], n["b"]))
    out: list[str] = []
    now: list[str] = []
    pending: tuple[str, str | None] | None = None  # (kind, repair) of the word the last line left open

    def close() -> None:
        if now:
            out.append(" ".join(now))
            now.clear()

    for k, line in enumerate(text.split("\n"), 1):
        at = by.get(k, {})
        if "drop" in at:
            continue
        toks = line.split()
        if not toks:
            if pending is None:
                close()
            continue
        if pending is None and (line.startswith("  ") or _HEADING.match(line)):
            close()
        if "eaten" in at:
            toks = toks[1:]
        if "word" in at:
            fixes = dict(at["word"])
            toks = [_as(fixes[w], t) if (w := word_of(t)) in fixes else t for t in toks]
        if pending is not None and toks and now:
            kind, repair = pending
            whole = now[-1][:-1] + ("-" if kind == "compound" else "") + toks[0]
            now[-1] = _as(repair, whole) if repair else whole
            toks = toks[1:]
        pending = None
        now += toks
        for kind in ("join", "compound"):
            for repair, raw in at.get(kind, ()):
                if not now:
                    continue
                if raw is None:
                    pending = (kind, repair)
                else:  # the word ends on the next page
                    whole = now[-1][:-1] + ("-" if kind == "compound" else "") + raw
                    now[-1] = _as(repair, whole) if repair else whole
    close()
    return out
