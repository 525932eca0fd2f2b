"""Problem 9: one consistent form for texts that look the same.

1. Compatibility normalization, decomposed: full-width forms, ligatures and no-break forms become plain, raised and
   lowered characters and fractions (which look different) stay; accents are separate marks in canonical order.
2. Ignorable characters are deleted, every blank becomes a plain one, line ends become ``\\n``.
3. Each letter stands for its class of look-alikes. A text whose classes hold no letter that is only Cyrillic or only
   Greek is written in Latin. In any other text each token is a lattice of look-alikes; Viterbi picks each token's
   reading under character bigram scores of one script, then the scripts of the tokens of a line, with a cost for a
   change of script inside a word and a smaller one between words. In a word with a letter that is only Latin and none
   that is only of another script, letters that are alike in such company alone (kappa, rho, iota, some Armenian and
   Cherokee ones) may be read as Latin, at a cost: here the scores decide whether two texts are one.
4. Canonical composition.

The lattice of a text depends on its classes alone, so two texts of equal classes get the same form whatever characters
they were written with; texts of different classes get one form only by letters that are alike in company.

Character scores are bigram counts over every token of one script in the corpus; the count table is bounded by the
square of the letters of three scripts (the rest is one symbol), so it is the size of an alphabet, not of the corpus.

Defined cases: null stays null and empty stays empty; neither they nor blank texts (nothing but blanks and ignorable
characters) have look-alikes; texts equal character by character are no case; letter case, accents, raised digits and
wording are kept. Repeated rows are handled each for itself; empty tables give empty results; extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.cluster import cut, spread

#: Letters that look the same in Latin, Cyrillic and Greek ("-" where a script has none).
LOOKALIKES = """
A А Α
B В Β
C С -
E Е Ε
H Н Η
I І Ι
J Ј -
K К Κ
M М Μ
N - Ν
O О Ο
P Р Ρ
S Ѕ -
T Т Τ
X Х Χ
Y У Υ
Z - Ζ
a а -
c с -
d ԁ -
e е -
h һ -
i і -
j ј -
o о ο
p р -
q ԛ -
Q Ԛ -
W Ԝ -
s ѕ -
v - ν
w ԝ -
x х -
y у -
"""
#: Letters of other scripts that are taken for a Latin one inside a Latin word only: there the lattice holds
#: both, elsewhere they are letters of their own.
WEAK = """
i ι
k к κ
p ρ
u υ ս
h հ
n ո
o օ
q զ
g ց
A Ꭺ
B Ᏼ
C Ꮯ
D Ꭰ
E Ꭼ
G Ꮐ
H Ꮋ
J Ꭻ
K Ꮶ
L Ꮮ
M Ꮇ
P Ꮲ
R Ꭱ
S Ꮪ
T Ꭲ
V Ꮩ
W Ꮃ
Z Ꮓ
"""
#: Ignorable characters (deleted), blanks (one plain blank), hyphens that look like the plain one.
IGNORABLE = "­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁯ㅤ︀-️﻿ﾠ\U000e0000-\U000e0fff"
BLANKS = "\t   -   　"
HYPHENS = "‐‑"
KEEP_TAGS = ("<super>", "<sub>", "<fraction>", "<square>", "<circle>")

_ROWS = [tuple(None if x == "-" else x for x in line.split()) for line in LOOKALIKES.split("\n") if line]
#: Every member of a class -> the class's Latin letter.
TO_CLASS = {ord(x): row[0] for row in _ROWS for x in row if x}
READINGS = {row[0]: row for row in _ROWS}
TAKEN_FOR = {x: row[0] for row in map(str.split, WEAK.strip().split("\n")) for x in row[1:]}
_WEAK = re.compile(f"[{''.join(TAKEN_FOR)}]")
_IGNORED = re.compile(f"[{IGNORABLE}]")
_BLANK = re.compile(f"[{BLANKS}]")
_HYPHEN = re.compile(f"[{HYPHENS}]")
_LINE_END = re.compile("\r\n?|[\x0b\x0c\x85  ]")
_SCRIPTS = ("latin", "cyrillic", "greek")


class _Plain(dict):
    """Code point -> its plain decomposed form, computed once."""

    def __missing__(self, cp: int) -> str:
        ch = chr(cp)
        tag = unicodedata.decomposition(ch).split(" ")[0]
        form = unicodedata.normalize("NFD" if tag in KEEP_TAGS or (tag.startswith("<") and ch.isspace()) else "NFKD", ch)
        self[cp] = form
        return form


_PLAIN = _Plain()


def classes(text: str) -> str:
    """The text with every character replaced by what it looks like; equal for texts that look the same."""
    if not text.isascii():
        text = _BLANK.sub(" ", _IGNORED.sub("", text))
        text = unicodedata.normalize("NFD", text.translate(_PLAIN))
        text = _HYPHEN.sub("-", text).translate(TO_CLASS)
    elif "\t" in text:
        text = text.replace("\t", " ")
    return _LINE_END.sub("\n", text)


def _own(lo: int, hi: int) -> str:
    return "".join(chr(c) for c in range(lo, hi) if c not in TO_CLASS and chr(c).isalpha())


_CYRILLIC = re.compile(f"[{_own(0x400, 0x530)}]")
_GREEK = re.compile(f"[{_own(0x370, 0x400)}]")
_TOKEN = re.compile(r"[^\W\d_](?:[^\W\d_]|[̀-ͯ])*")
_ALL_MARKS = re.compile("[̀-ͯ]")


def script_of(ch: str) -> int | None:
    """0, 1, 2 for a letter of Latin, Cyrillic, Greek; None for any other character."""
    c = ord(ch)
    if c < 0x250 or 0x1E00 <= c < 0x1F00:
        return 0 if ch.isalpha() else None
    return 1 if 0x400 <= c < 0x530 else 2 if 0x370 <= c < 0x400 else None


def count_pairs(texts: list[str | None]) -> Counter:
    """(script, letter, next letter) counts over the tokens of one script; ``^`` and ``$`` are a token's ends."""
    tokens: Counter = Counter()
    for t in texts:
        if t:
            tokens.update(_TOKEN.findall(unicodedata.normalize("NFD", t)))
    pairs: Counter = Counter()
    for tok, n in tokens.items():
        letters = _ALL_MARKS.sub("", tok)
        scripts = {script_of(c) for c in letters}
        if len(scripts) == 1 and (s := scripts.pop()) is not None:
            low = [c if ord(c) < 0x530 else "?" for c in letters.lower()]
            for a, b in zip(["^", *low], [*low, "$"]):
                pairs[(s, a, b)] += n
    return pairs


class Reader:
    """Viterbi over look-alike lattices with bigram scores of one corpus."""

    SWITCH_IN_WORD, SWITCH_BETWEEN, IN_COMPANY = 12.0, 2.0, 3.0

    def __init__(self, counts: dict[tuple[int, str, str], int]) -> None:
        first: Counter = Counter()
        for (s, a, _), n in counts.items():
            first[(s, a)] += n
        self.score = {k: math.log((n + 0.5) / (first[k[:2]] + 50)) for k, n in counts.items()}
        self.floor = {k: math.log(0.5 / (n + 50)) for k, n in first.items()}
        self.cache: dict[str, tuple] = {}

    def _pair(self, s: int, a: str, b: str) -> float:
        v = self.score.get((s, a, b))
        return v if v is not None else self.floor.get((s, a), math.log(0.01))

    def token(self, tok: str) -> tuple[tuple[float, str], ...]:
        """Per script in which the token ends, the best score and reading, over all paths through its lattice."""
        if (got := self.cache.get(tok)) is not None:
            return got
        best: dict[int, tuple[float, str, str]] | None = None
        own = [(script_of(c), c in TAKEN_FOR) for c in tok if c not in READINGS]
        company = any(s == 0 for s, _ in own) and not any(s in (1, 2) and not weak for s, weak in own)
        for ch in tok:
            row, taken, s = READINGS.get(ch), TAKEN_FOR.get(ch) if company else None, script_of(ch)
            if row is None and s is None and taken is None:  # a mark belongs to the letter before it
                best = {k: (v, r + ch, p) for k, (v, r, p) in (best or {0: (0.0, "", "^")}).items()}
                continue
            options = [(i, x, 0.0) for i, x in enumerate(row) if x] if row else [(s, ch, 0.0)] if s is not None else []
            options += [(0, taken, self.IN_COMPANY)] if taken is not None else []
            step = {}
            for i, x, cost in options:
                low = x.lower()
                if best is None:
                    step[i] = (self._pair(i, "^", low) - cost, x, low)
                else:
                    v, r, j = max((v + self._pair(i, p if j == i else "^", low) - (self.SWITCH_IN_WORD if j != i else 0), r, j) for j, (v, r, p) in best.items())
                    step[i] = (v - cost, r + x, low)
            best = step
        out = tuple((v + self._pair(i, p, "$"), r, i) for i, (v, r, p) in sorted((best or {}).items()))
        if len(self.cache) > 500_000:
            self.cache.clear()
        self.cache[tok] = out
        return out

    def line(self, line: str, allowed: set[int]) -> str:
        """The line with the scripts of its tokens chosen together."""
        spans = [(m.start(), m.end()) for m in _TOKEN.finditer(line)]
        if not spans:
            return line
        path: list[dict[int, tuple[float, int | None, str]]] = []
        for a, b in spans:
            choices = self.token(line[a:b])
            choices = tuple(c for c in choices if c[2] in allowed) or choices
            step = {}
            for v, r, i in choices:
                if path:
                    w, j = max((w - (self.SWITCH_BETWEEN if j != i else 0.0), -j) for j, (w, _, _) in path[-1].items())
                    step[i] = (v + w, -j, r)
                else:
                    step[i] = (v - (self.SWITCH_BETWEEN if i else 0.0), None, r)
            path.append(step)
        i = max(path[-1], key=lambda k: (path[-1][k][0], -k))
        picked = []
        for step in reversed(path):
            _, j, r = step[i]
            picked.append(r)
            i = j if j is not None else i
        out, at = [], 0
        for (a, b), r in zip(spans, reversed(picked)):
            out += [line[at:a], r]
            at = b
        return "".join([*out, line[at:]])

    def read(self, seen: str) -> str:
        """The consistent form of a text given as classes."""
        if seen.isascii():
            return seen
        allowed = {0} | ({1} if _CYRILLIC.search(seen) else set()) | ({2} if _GREEK.search(seen) else set())
        if len(allowed) > 1 or _WEAK.search(seen):
            seen = "\n".join(self.line(x, allowed) for x in seen.split("\n"))
        return unicodedata.normalize("NFC", seen)


def pair_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(script, a, b, n) over the whole corpus, combined per partition before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in batches:
            total.update(count_pairs(batch.column(0).to_pylist()))
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.string()), pa.array(list(total.values()), pa.int64())],
            ["script", "a", "b", "n"],
        )

    parts = spread(docs.select(text)).mapInArrow(run, "script int, a string, b string, n bigint")
    return parts.groupBy("script", "a", "b").agg(F.sum("n").alias("n"))


def consistent(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, consistent): the one consistent form of each text."""
    # bounded by the pairs of letters of three scripts, whatever the corpus
    counts = {(r.script, r.a, r.b): r.n for r in pair_counts(docs, text).collect()}
    shared, kind = docs.sparkSession.sparkContext.broadcast(counts), docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(shared.value)
        for batch in batches:
            forms = [t if not t else reader.read(classes(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forms, pa.string())], [key, "consistent"])

    return spread(docs.select(key, text)).mapInArrow(run, f"`{key}` {kind}, consistent string")


def same_looking(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b) pairs a < b of keys whose texts look the same but differ in characters.

    Only 128-bit names of form and text leave the first stage, never texts. Forms written in one way only are dropped
    by an aggregate with map-side combine before any pair is made; the pairs that are left are the result itself."""
    forms = cut(consistent_names(docs, key, text))
    ways = forms.groupBy("form").agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).where("lo <> hi").select("form")
    left = forms.join(ways, "form", "left_semi")
    a, b = left.select("form", F.col(key).alias("a"), F.col("raw").alias("raw_a")), left.select("form", F.col(key).alias("b"), F.col("raw").alias("raw_b"))
    return a.join(b, "form").where("a < b and raw_a <> raw_b").select("a", "b").distinct()


def consistent_names(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, form, raw): names of the consistent form and of the text as it is; null, empty and blank texts left out."""
    counts = {(r.script, r.a, r.b): r.n for r in pair_counts(docs, text).collect()}
    shared, kind = docs.sparkSession.sparkContext.broadcast(counts), docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from hashlib import blake2b

        reader = Reader(shared.value)
        for batch in batches:
            ids, form, raw = [], [], []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t and (c := reader.read(classes(t))).strip():
                    ids.append(i)
                    form.append(blake2b(c.encode(), digest_size=16).digest())
                    raw.append(blake2b(t.encode(), digest_size=8).digest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.column(0).type), pa.array(form, pa.binary()), pa.array(raw, pa.binary())], [key, "form", "raw"])

    return spread(docs.select(key, text)).mapInArrow(run, f"`{key}` {kind}, form binary, raw binary")
