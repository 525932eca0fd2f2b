"""Problem 4: long exact spans shared between records, by recompression.

Texts are parsed by rounds of recompression: maximal runs of equal symbols get one name, then adjacent symbols a, b get
one name wherever a's name falls in the round's left half of the alphabet and b's in the right half. A name is a 64-bit
hash of what it stands for, so names are global without any exchange, and whether two neighbours merge depends on them
alone: equal substrings get equal symbols but for a few at their ends. Symbols of ``STOP`` characters or more are left
as they are, which bounds what the ends of a substring can lose.

High-level symbols are named stretches of consecutive interior symbols of at least ``HIGH`` characters; of their starts
the least-named of every ``EVERY`` neighbours are kept. Texts that share a high-level symbol are verified and extended
character by character. Runs of ``RUN`` characters and more, whose length differs with their place, have symbols of
their own at either end and at steps between. Runs of ``SHORT_RUN`` characters and more also name the ``BESIDE``
characters before and after them: a span of ``SPAN`` characters that is cut inside a run at both ends holds those.

Every text is parsed once. A symbol that two texts of one batch share is known to be shared there and then, and but for
one of its rows these are spread over the cluster; so a symbol that stands in a third of all texts meets in one task with
one row a batch. Symbols that stand in one text only are dropped. Groups of up to ``GROUP`` occurrences are paired and
verified; for larger groups all substrings of ``span`` characters around the occurrences get 124-bit names instead
(residues of polynomials to four primes, which repetitive texts do not bring to collide) and are grouped by these. Of the
substrings that stand in the same set of texts one is kept, so a header of any length is one group, not one a position.
Copies of a text are one class throughout; ``members`` gives the groups as they are, ``pairs`` expands them, in parts.

Defined cases: repeated rows of an id count once (latest ``loaded_at``), and a content that only superseded rows hold is
nowhere; null, empty and shorter contents share nothing; lengths and positions are in code points, white space included;
a record is not compared with itself; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quire.functions.cluster import cut, latest, spread

SPAN = 200
STOP, ROUNDS = 8, 5
HIGH, EVERY, RUN, EVERY_RUN = 80, 6, 64, 96
SHORT_RUN, BESIDE = 16, 64  # between two parts of runs below RUN lie SPAN - 2 * (RUN - 1) = 74 characters or more
GROUP = 64
PART = 1024  # members of a group that meet all others in one task

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit names."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def letter_names(points: np.ndarray) -> np.ndarray:
    return mix(points.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))


_LETTERS = letter_names(np.arange(1 << 16, dtype=np.uint32))


class Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, b in (("up", _BASE), ("down", _INVERSE)):
                a = np.full(2 * n, np.uint64(b), np.uint64)
                a[0] = 1
                setattr(self, name, np.multiply.accumulate(a))
        return self.up[:n], self.down[:n]


_POWERS = Powers()


class Parsed:
    """Texts of one batch side by side: code points, prefix hashes, and symbol starts after recompression."""

    def __init__(self, texts: list[str]) -> None:
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])
        letters = _LETTERS[self.points] if len(self.points) and self.points.max() < len(_LETTERS) else letter_names(self.points)
        n = len(letters)
        self.up, self.down = _POWERS.to(n + 1)
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(letters * self.up[:n], out=self.prefix[1:])
        self._recompress(letters)

    def name(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Names of the substrings [a, b): equal for equal substrings."""
        return mix((self.prefix[b] - self.prefix[a]) * self.down[a] + (b - a).astype(np.uint64))

    def _recompress(self, letters: np.ndarray) -> None:
        sym, n = letters, len(letters)
        start = np.arange(n, dtype=np.int64)
        text = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        long_runs: list[np.ndarray] = []
        sides: list[np.ndarray] = []
        for r in range(ROUNDS):
            if len(sym) < 2:
                break
            size = np.diff(start, append=n)
            # runs of one symbol
            fresh = np.ones(len(sym), bool)
            fresh[1:] = (sym[1:] != sym[:-1]) | (text[1:] != text[:-1]) | (size[1:] >= STOP)
            at = np.flatnonzero(fresh)
            times = np.diff(at, append=len(sym))
            s, st = sym[at], start[at]
            many = times > 1
            if many.any():
                whole = np.diff(st, append=n)
                short = many & (whole >= SHORT_RUN)
                sides.append(np.stack([st[short], st[short] + whole[short]], 1))
                big = many & (whole >= RUN)
                if big.any():
                    long_runs.append(np.stack([st[big], st[big] + whole[big], s[big].view(np.int64), whole[big] // times[big]], 1))
                k = np.flatnonzero(many)
                s[k] = mix(s[k] + times[k].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            sym, start, text = s, st, text[at]
            # pairs of a left and a right symbol
            size = np.diff(start, append=n)
            side = (mix(sym + np.uint64((r + 1) * 0xA0761D6478BD642F & (1 << 64) - 1)) & np.uint64(1)).astype(bool)
            free = size < STOP
            join = np.zeros(len(sym), bool)
            join[:-1] = side[:-1] & ~side[1:] & free[:-1] & free[1:] & (text[1:] == text[:-1])
            right = np.zeros(len(sym), bool)
            right[1:] = join[:-1]
            both = np.flatnonzero(join)
            sym[both] = mix(sym[both] * np.uint64(3) + mix(sym[both + 1]))
            keep = ~right
            sym, start, text = sym[keep], start[keep], text[keep]
        self.sym, self.start, self.text = sym, start, text
        self.runs = np.concatenate(long_runs) if long_runs else np.zeros((0, 4), np.int64)
        self.sides = np.concatenate(sides) if sides else np.zeros((0, 2), np.int64)

    def high(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(name, text, position in the text) of the high-level symbols."""
        n = len(self.sym)
        parts = []
        if n:
            ends = self.begins[self.text + 1]
            # the first symbol start at least HIGH characters on, within the same text (its end is a start, too)
            marks = np.append(self.start, len(self.points))
            stop = marks[np.minimum(np.searchsorted(marks, self.start + HIGH), n)]
            ok = stop <= ends
            rank = mix(self.sym ^ np.uint64(0x8EBC6AF09C88C6E3))
            best = np.arange(n)
            for k in range(1, EVERY):  # the least of each window of EVERY neighbours, the first among equals
                other = np.arange(n) + k
                other[other >= n] = n - 1
                best = np.where(rank[other] < rank[best], other, best)
            chosen = np.zeros(n, bool)
            chosen[best] = True
            at = np.flatnonzero(chosen & ok)
            parts.append((self.name(self.start[at], stop[at]), self.text[at], self.start[at]))
        if len(self.runs):
            # two runs of one symbol may meet at any shift by whole periods: both ends, one period inside them, and every
            # EVERY_RUN characters give seeds whose shifts cover all that the runs share
            a, b, base, period = self.runs[:, 0], self.runs[:, 1], self.runs[:, 2].view(np.uint64), self.runs[:, 3]
            step = period * np.maximum(1, EVERY_RUN // period)
            count = np.maximum(1, (b - a - 1) // step + 1)
            k = np.repeat(np.arange(len(a)), count)
            inner = a[k] + (np.arange(len(k)) - np.repeat(np.cumsum(count) - count, count)) * step[k]
            owner = np.searchsorted(self.begins, a, side="right") - 1
            left, right = mix(base ^ np.uint64(0x1D8E4E27C47D124F)), mix(base ^ np.uint64(0x5851F42D4C957F2D))
            parts += [(left[k], owner[k], inner), (left, owner, a + period), (right, owner, b - 1), (right, owner, b - 1 - period)]
        if len(self.sides):
            owner = np.searchsorted(self.begins, self.sides[:, 0], side="right") - 1
            for at in (self.sides[:, 0] - BESIDE, self.sides[:, 1]):
                ok = (at >= self.begins[owner]) & (at + BESIDE <= self.begins[owner + 1])
                parts.append((self.name(at[ok], at[ok] + BESIDE), owner[ok], at[ok]))
        if not parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        names, owners, at = (np.concatenate([p[i] for p in parts]) for i in range(3))
        return names, owners, at - self.begins[owners]


def content_class(content: Column) -> Column:
    """A 128-bit name of a content; copies are one class."""
    return F.unhex(F.md5(F.to_binary(content, F.lit("utf-8"))))


def _classes(files: DataFrame, span: int) -> DataFrame:
    """(cls, content) of the contents long enough; copies may still be there more than once."""
    return files.where(F.length("content") >= span).select(content_class(F.col("content")).alias("cls"), "content")


def _rows(names: tuple[np.ndarray, ...], owners: np.ndarray, at: np.ndarray, cls: list[bytes], first: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of one batch for ``_shared``: (k1[, k2], cls, at, n1[, n2]). ``at`` holds place * 8 + first * 4 + flag: 0 for a
    name that one text of the batch holds, 1 for one row of a name that several hold, 2 for their other rows; these are
    keyed by name and text (``n`` keeps the name), all others by the name."""
    order = np.lexsort(names[::-1])
    sorted_ = [x[order] for x in names]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([x[1:] != x[:-1] for x in sorted_])
    own = owners[order]
    begins = np.flatnonzero(new)
    several = np.minimum.reduceat(own, begins) != np.maximum.reduceat(own, begins) if len(begins) else np.zeros(0, bool)
    flag = np.zeros(len(order), np.int64)
    flag[order] = np.where(several[np.cumsum(new) - 1], np.where(new, 1, 2), 0)
    # rows stay in the order of the texts, in which they are a third of the size when compressed
    spread_ = np.array([int.from_bytes(c[:8], "little") for c in cls], np.uint64)
    key = np.where(flag == 2, mix(names[0] ^ spread_[owners]), names[0]) if len(order) else names[0]
    place = at.astype(np.int64) * 8 + flag + (4 * first if first is not None else 0)
    columns = [pa.array(key.view(np.int64)), *[pa.array(x.view(np.int64)) for x in names[1:]], pa.array(cls, pa.binary()).take(pa.array(owners, pa.int64())), pa.array(place)]
    columns.append(pa.array(names[0].view(np.int64), mask=flag != 2))
    return pa.RecordBatch.from_arrays(columns, ["k1", *["k2"] * (len(names) - 1), "cls", "at", "n1"])


def _shared(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(name columns, cls, pos, first): rows of ``_rows`` whose name stands in two texts. One exchange, no self-join."""
    w = Window.partitionBy(*keys)
    flag, c = F.col("at").bitwiseAND(3), F.xxhash64("cls")
    seen = rows.select("*", flag.alias("flag"), F.min(c).over(w).alias("lo"), F.max(c).over(w).alias("hi"), F.max(flag).over(w).alias("most"))
    seen = seen.where("flag = 2 or most = 1 or lo <> hi")
    return seen.select(F.coalesce("n1", "k1").alias("g1"), *[F.col(k).alias("g2") for k in keys[1:]], "cls", F.shiftright("at", 3).cast("int").alias("pos"), (F.col("at").bitwiseAND(4) > 0).alias("first"))


def symbols(classes: DataFrame) -> DataFrame:
    """High-level symbols of every text, as ``_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[bytes] = set()
            ids: list[bytes] = []
            parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            texts, size, held = [], 0, 0
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for k, (c, t) in enumerate(rows):
                if c not in seen:
                    seen.add(c)
                    ids.append(c)
                    texts.append(t)
                    size += len(t)
                last = k + 1 == len(rows)
                if texts and (size > 500_000 or last):  # bounded memory
                    names, owners, at = Parsed(texts).high()
                    parts.append((names, owners + len(ids) - len(texts), at))
                    held += len(names)
                    texts, size = [], 0
                if parts and (held > 2_000_000 or last):
                    names, owners, at = (np.concatenate([p[i] for p in parts]) for i in range(3))
                    yield _rows((names,), owners, at, ids)
                    parts, held, ids = [], 0, []

    return spread(classes).mapInArrow(run, "k1 bigint, cls binary, at bigint, n1 bigint")


class Windows:
    """124-bit names of all substrings of one length of a text: residues of a polynomial to four primes below 2**31."""

    PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
    BASES = (911382323, 1372383749, 572163841, 1948672301)
    _powers: list[tuple[np.ndarray, np.ndarray]] = [(np.ones(1, np.int64), np.ones(1, np.int64)) for _ in PRIMES]

    @classmethod
    def powers(cls, i: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        p, (up, down) = cls.PRIMES[i], cls._powers[i]
        while len(up) < n:
            up = np.concatenate([up, up * pow(cls.BASES[i], len(up), p) % p])
            down = np.concatenate([down, down * pow(cls.BASES[i], -len(down), p) % p])
        cls._powers[i] = (up, down)
        return up[:n], down[:n]

    @classmethod
    def names(cls, text: str, starts: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        got = []
        for i, p in enumerate(cls.PRIMES):
            up, down = cls.powers(i, len(points))
            prefix = np.zeros(len(points) + 1, np.int64)
            np.cumsum(points * up % p, out=prefix[1:])
            got.append((prefix[starts + span] - prefix[starts]) % p * down[starts] % p)
        return (got[0] | got[1] << 31).astype(np.uint64), (got[2] | got[3] << 31).astype(np.uint64)


def _matches(a: str, b: str, seeds: list[tuple[int, int]], span: int) -> list[tuple[int, int, int]]:
    """Maximal equal stretches of at least ``span`` characters through the seeds, as (start in a, start in b, length)."""
    out = []
    done: dict[int, int] = {}
    for i, j in sorted(seeds):
        d = i - j
        if i < done.get(d, -1) or i >= len(a) or j >= len(b) or a[i] != b[j]:
            continue
        x, y = i, j
        step = 64
        while x and y:  # to the left, by blocks and then by characters
            k = min(step, x, y)
            if a[x - k : x] == b[y - k : y]:
                x, y = x - k, y - k
            elif k == 1:
                break
            else:
                step = max(1, k // 2)
        u, v = i, j
        step = 64
        while u < len(a) and v < len(b):
            k = min(step, len(a) - u, len(b) - v)
            if a[u : u + k] == b[v : v + k]:
                u, v = u + k, v + k
            elif k == 1:
                break
            else:
                step = max(1, k // 2)
        done[d] = u
        if u - x >= span:
            out.append((x, y, u - x))
    return out


def _texts(classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(cls, content) once for each wanted class."""
    return classes.join(wanted, "cls", "left_semi").groupBy("cls").agg(F.first("content").alias("content"))


def _met(groups: DataFrame, group: list[str], member: str) -> DataFrame:
    """(a, b) of all two members a < b of each group. The rows are the result; a large group is cut into parts of about
    ``PART`` members, each of which meets the whole group in a task of its own."""
    n = groups.groupBy(*group).agg(F.greatest(F.lit(1), F.ceil(F.count("*") / PART)).cast("int").alias("parts")).where("parts > 1")
    g = groups.join(n, group, "left").fillna(1, ["parts"])
    a = g.select(*group, F.col(member).alias("a"), F.pmod(F.xxhash64(member), F.col("parts")).cast("int").alias("part"))
    b = g.select(*group, F.col(member).alias("b"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return a.join(b, [*group, "part"]).where("a < b").select("a", "b")


class Shared:
    """Spans of at least ``span`` characters that stand in two different contents."""

    def __init__(self, files: DataFrame, span: int = SPAN) -> None:
        if span < SPAN:
            raise ValueError(f"high-level symbols are made for spans of at least {SPAN} characters")
        self.files, self.span = files, span
        self.classes = _classes(files, span)
        self.ids = cut(self._ids())
        live = self.ids.where(F.col("n_chars") >= span).select("cls").distinct()
        both = _shared(symbols(self.classes), ["k1"]).select(F.col("g1").alias("sym"), "cls", "pos")
        self.both = cut(both.join(live, "cls", "left_semi"))
        self.hot = cut(self.both.groupBy("sym").agg(F.count("*").alias("n")).where(F.col("n") > GROUP).select("sym"))

    def spans(self) -> DataFrame:
        """(cls_a, cls_b, start_a, start_b, length) from groups of at most ``GROUP`` occurrences."""
        span = self.span
        few = self.both.join(self.hot, "sym", "left_anti")
        group = few.groupBy("sym").agg(F.sort_array(F.collect_set(F.struct("cls", "pos"))).alias("g"))
        pair = group.select(F.posexplode("g").alias("i", "a"), "g").select("a", F.explode(F.slice("g", F.col("i") + 2, F.lit(GROUP))).alias("b")).where("a.cls < b.cls")
        pair = pair.groupBy(F.col("a.cls").alias("cls_a"), F.col("b.cls").alias("cls_b")).agg(F.collect_set(F.struct(F.col("a.pos").alias("i"), F.col("b.pos").alias("j"))).alias("seeds"))
        pair = cut(pair)
        wanted = pair.select(F.explode(F.array("cls_a", "cls_b")).alias("cls")).distinct()
        text = _texts(self.classes, wanted)
        rows = pair.join(text.select(F.col("cls").alias("cls_a"), F.col("content").alias("text_a")), "cls_a").join(text.select(F.col("cls").alias("cls_b"), F.col("content").alias("text_b")), "cls_b")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[tuple] = []
                for ca, cb, ta, tb, seeds in zip(*[c.to_pylist() for c in batch.columns]):
                    out += [(ca, cb, *m) for m in _matches(ta, tb, [(s["i"], s["j"]) for s in seeds], span)]
                cols = list(zip(*out)) if out else [[]] * 5
                kinds = (pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["cls_a", "cls_b", "start_a", "start_b", "length"])

        return rows.select("cls_a", "cls_b", "text_a", "text_b", "seeds").mapInArrow(run, "cls_a binary, cls_b binary, start_a int, start_b int, length int")

    def grams(self) -> DataFrame:
        """(g1, g2, cls, pos, first): the exact substrings of ``span`` characters around the occurrences of the larger groups
        that stand in more than one content; ``first`` in one row of each content. Linear in the occurrences, whatever the
        size of a group."""
        span = self.span
        many = self.both.join(self.hot, "sym", "left_semi").groupBy("cls").agg(F.collect_set("pos").alias("at"))
        text = _texts(self.classes, many.select("cls"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                parts: list[tuple] = []
                ids: list[bytes] = []
                held = 0
                rows = list(zip(*[x.to_pylist() for x in batch.columns]))
                for k, (c, t, at) in enumerate(rows):
                    near = np.zeros(len(t) - span + 2, np.int32)
                    for i in at:
                        near[max(0, i - span + 1)] += 1
                        near[min(i, len(t) - span) + 1] -= 1
                    starts = np.flatnonzero(np.cumsum(near[:-1]) > 0)
                    g1, g2 = Windows.names(t, starts, span)
                    order = np.lexsort((starts, g2, g1))
                    first = np.zeros(len(starts), np.int64)
                    first[order] = np.concatenate([[True], (g1[order][1:] != g1[order][:-1]) | (g2[order][1:] != g2[order][:-1])])[: len(starts)]
                    parts.append((g1, g2, np.full(len(starts), len(ids)), starts, first))
                    ids.append(c)
                    held += len(starts)
                    if held > 1_000_000 or k + 1 == len(rows):
                        g1, g2, owners, starts, first = (np.concatenate([p[i] for p in parts]) for i in range(5))
                        yield _rows((g1, g2), owners, starts, ids, first)
                        parts, ids, held = [], [], 0

        rows = many.join(text, "cls").select("cls", "content", "at").mapInArrow(run, "k1 bigint, k2 bigint, cls binary, at bigint, n1 bigint")
        return _shared(rows, ["k1", "k2"])

    def _ids(self) -> DataFrame:
        """(file_id, cls, n_chars) of every record, its latest row."""
        rows = self.files.where("file_id is not null").select("file_id", "loaded_at", content_class(F.coalesce("content", F.lit(""))).alias("cls"), F.coalesce(F.length("content"), F.lit(0)).alias("n_chars"))
        return latest(rows, ["file_id"], "loaded_at").select("file_id", "cls", "n_chars")

    def _groups(self) -> DataFrame:
        """(g1, g2, cls): the contents that share a substring, one group for all substrings that the same contents hold."""
        one = cut(self.grams().where("first").select("g1", "g2", "cls"))
        of = one.groupBy("g1", "g2").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("cls")).alias("x"), F.bit_xor(F.xxhash64("cls", F.lit(1))).alias("y"))
        kept = of.groupBy("n", "x", "y").agg(F.min(F.struct("g1", "g2")).alias("g")).select("g.g1", "g.g2")
        return one.join(kept, ["g1", "g2"])

    def members(self) -> DataFrame:
        """(group_id, file_id): the records of each group whose contents hold one span, as linear rows: copies of a content,
        two contents of a verified span, or all contents of a span that many hold. Two records share a span if and only
        if they are together in a group."""
        ids = self.ids.where(F.col("n_chars") >= self.span).select("file_id", "cls")
        name = lambda *c: F.sha2(F.concat(*c), 256)
        copied = ids.groupBy("cls").agg(F.count("*").alias("n")).where("n > 1").select("cls", name(F.col("cls")).alias("group_id"))
        two = self.spans().select("cls_a", "cls_b").distinct().select(name(F.col("cls_a"), F.col("cls_b")).alias("group_id"), F.explode(F.array("cls_a", "cls_b")).alias("cls"))
        many = self._groups().select(name(F.hex("g1"), F.lit(" "), F.hex("g2")).alias("group_id"), "cls")
        groups = copied.select("group_id", "cls").unionByName(two).unionByName(many)
        return groups.join(ids, "cls").select("group_id", "file_id")

    def pairs(self) -> DataFrame:
        """(a, b), a < b: records that share a span, copies of one content included. The classes' pairs are expanded to the
        pairs of records, which are the result."""
        ids = self.ids.where(F.col("n_chars") >= self.span).select("file_id", "cls")
        many = _met(self._groups(), ["g1", "g2"], "cls").select(F.col("a").alias("cls_a"), F.col("b").alias("cls_b"))
        cls = self.spans().select("cls_a", "cls_b").unionByName(many).distinct()
        x, y = ids.select(F.col("file_id").alias("x"), F.col("cls").alias("cls_a")), ids.select(F.col("file_id").alias("y"), F.col("cls").alias("cls_b"))
        far = cls.join(x, "cls_a").join(y, "cls_b").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        copied = ids.groupBy("cls").agg(F.count("*").alias("n")).where("n > 1").select("cls")
        # a record has one class and two classes one row, so no pair comes twice
        return far.unionByName(_met(ids.join(copied, "cls", "left_semi"), ["cls"], "file_id"))

    def stretches(self) -> DataFrame:
        """(cls, start, stop): merged stretches of each content that stand in another one."""
        s = cut(self.spans())
        one = s.select(F.col("cls_a").alias("cls"), F.col("start_a").alias("start"), (F.col("start_a") + F.col("length")).alias("stop"))
        two = s.select(F.col("cls_b").alias("cls"), F.col("start_b").alias("start"), (F.col("start_b") + F.col("length")).alias("stop"))
        hot = self.grams().select("cls", F.col("pos").alias("start"), (F.col("pos") + self.span).alias("stop"))
        all_ = one.unionByName(two).unionByName(hot).groupBy("cls", "start").agg(F.max("stop").alias("stop"))
        w = Window.partitionBy("cls").orderBy("start")
        reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
        marked = all_.withColumn("new", F.when(F.col("start") <= reach, 0).otherwise(1))
        marked = marked.withColumn("island", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return marked.groupBy("cls", "island").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("island")

    def portions(self) -> DataFrame:
        """(file_id, n_chars, copies, shared_chars, share) of every record: how much of it stands elsewhere."""
        ids = self.ids
        n = ids.groupBy("cls").agg(F.count("*").alias("copies"))
        got = self.stretches().groupBy("cls").agg(F.sum(F.col("stop") - F.col("start")).alias("part"))
        rows = ids.join(n, "cls").join(got, "cls", "left")
        whole = (F.col("copies") > 1) & (F.col("n_chars") >= self.span)
        shared = F.when(whole, F.col("n_chars")).otherwise(F.coalesce("part", F.lit(0))).cast("bigint")
        return rows.select("file_id", "n_chars", F.col("copies"), shared.alias("shared_chars"), F.when(F.col("n_chars") > 0, F.round(shared / F.col("n_chars"), 6)).otherwise(0.0).alias("share"))
