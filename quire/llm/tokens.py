"""Problem 7: a whole corpus as ids of a public byte-level BPE vocabulary, by recursive DuckDB queries per partition.

Each Arrow batch is cut into words by the vocabulary's own pattern. The words not met before by this worker go to an
in-process DuckDB as token-position rows; a recursive query joins them with the merge table and contracts, in each word,
all places of its pair of least rank from the left, until no word has a pair left; an ordered aggregation gives each
word's ids. (A pair made by a merge ranks after that merge, so all places of one pair are contracted before any other.) A
worker keeps the ids of the words it has met, so the query runs on new words only, and no shuffle is needed at any size.
``decoded`` gives the texts back: ids join the vocabulary's pieces, an ordered aggregation writes them.

A word needs one round for each different pair it merges. Words of more than ``LONG`` bytes (texts without blanks) can
need thousands; they take the same rule with a heap, in n log n.

Defined cases: null and empty text give an empty list; blank text is encoded like any other; strings that look like
special tokens are ordinary text; repeated rows are encoded each for itself; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions.cluster import spread

VOCAB_DIR = "/opt/tokenizers"
VOCAB = "byte_bpe_50k.json"
LONG = 512
KEEP = 1_000_000  # words a worker keeps before it starts anew

#: The word pattern that belongs to the vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

STEP = """
WITH RECURSIVE state(step, w, pos, tok) AS (
    SELECT 0, w, pos, tok FROM start
    UNION ALL
    SELECT step + 1, w, pos, CASE WHEN hit THEN merged ELSE tok END
    FROM (
        SELECT *, lag(hit, 1, false) OVER (PARTITION BY w ORDER BY pos) AS eaten
        FROM (
            -- of places that overlap, in a run of one token, every second one from the left
            SELECT *, place AND (nth - max(CASE WHEN NOT place THEN nth ELSE 0 END) OVER (PARTITION BY w ORDER BY pos)) % 2 = 1 AS hit
            FROM (
                SELECT *, coalesce(rank = best, false) AS place
                FROM (
                    SELECT p.step, p.w, p.pos, p.tok, p.nth, m.rank, m.merged, min(m.rank) OVER (PARTITION BY p.w) AS best
                    FROM (
                        SELECT step, w, pos, tok, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS after, row_number() OVER (PARTITION BY w ORDER BY pos) AS nth
                        FROM state
                    ) p LEFT JOIN merges m ON p.tok = m.l AND p.after = m.r
                ) WHERE best IS NOT NULL
            )
        )
    ) WHERE NOT eaten
)
SELECT w, list(tok ORDER BY pos) AS ids
FROM state JOIN (SELECT w, max(step) AS step FROM state GROUP BY w) USING (w, step)
GROUP BY w
"""

PIECES = """
SELECT row, string_agg(piece, '' ORDER BY pos) AS written
FROM ids JOIN pieces ON ids.id = pieces.id
GROUP BY row
"""


def printable_bytes() -> dict[str, int]:
    """The vocabulary writes a byte as a printable character: itself where it is one, else the next from U+0100."""
    keep = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(keep)]
    return {chr(b): b for b in keep} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """The vocabulary in one worker: its merge table in DuckDB and the words met so far."""

    def __init__(self, vocabulary: bytes) -> None:
        import duckdb
        import regex

        model = json.loads(vocabulary)["model"]
        ids, merges = model["vocab"], model["merges"]
        pairs = [x.split(" ") if isinstance(x, str) else x for x in merges]
        self.byte_id = [0] * 256
        for ch, b in printable_bytes().items():
            self.byte_id[b] = ids[ch]
        left, right = [ids[a] for a, _ in pairs], [ids[b] for _, b in pairs]
        merged = [ids[a + b] for a, b in pairs]
        self.rank = {(a, b): (i, m) for i, (a, b, m) in enumerate(zip(left, right, merged))}
        self.words = regex.compile(PATTERN).findall
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "300MB"})
        table = pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "rank": pa.array(range(len(left)), pa.int32()), "merged": pa.array(merged, pa.int32())})
        self.db.register("given", table)
        self.db.execute("CREATE TABLE merges AS SELECT * FROM given")
        self.db.unregister("given")
        bytes_ = printable_bytes()
        self.pieces = {i: p for p, i in ids.items() if all(c in bytes_ for c in p)}
        self.octets = {ord(c): b for c, b in bytes_.items()}
        table = pa.table({"id": pa.array(list(self.pieces), pa.int32()), "piece": pa.array(list(self.pieces.values()), pa.string())})
        self.db.register("given", table)
        self.db.execute("CREATE TABLE pieces AS SELECT * FROM given")
        self.db.unregister("given")
        self.known: dict[str, list[int]] = {}

    def learn(self, words: list[str], block: int = 4000) -> None:
        """Ids of new words, a bounded number of rows to a query."""
        short, byte_id = [], self.byte_id
        for w in words:
            raw = w.encode()
            if len(raw) > LONG:
                self.known[w] = self.by_heap([byte_id[b] for b in raw])
            else:
                short.append((w, raw))
        for i in range(0, len(short), block):
            part = short[i : i + block]
            sizes = [len(raw) for _, raw in part]
            start = pa.table({  # noqa: F841 - read by DuckDB by name
                "w": pa.array([k for k, n in enumerate(sizes) for _ in range(n)], pa.int32()),
                "pos": pa.array([p for n in sizes for p in range(n)], pa.int32()),
                "tok": pa.array([byte_id[b] for _, raw in part for b in raw], pa.int32()),
            })
            self.db.register("start", start)
            got = self.db.sql(STEP).to_arrow_table()
            self.db.unregister("start")
            for k, ids in zip(got.column("w").to_pylist(), got.column("ids").to_pylist()):
                self.known[part[k][0]] = ids

    def decode(self, rows: pa.ListArray) -> list[str]:
        """The text of each row's ids; ids that are no piece of a text are left out, malformed bytes replaced."""
        lengths = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        total = int(lengths.sum())
        ids = pa.table({"row": pa.array(np.repeat(np.arange(len(lengths)), lengths)), "pos": pa.array(np.arange(total)), "id": rows.flatten().cast(pa.int32())})
        self.db.register("ids", ids)
        got = self.db.sql(PIECES).to_arrow_table()
        self.db.unregister("ids")
        written = dict(zip(got.column("row").to_pylist(), got.column("written").to_pylist()))
        return [bytes(map(self.octets.__getitem__, map(ord, written.get(k, "")))).decode("utf-8", "replace") for k in range(len(lengths))]

    def by_heap(self, toks: list[int]) -> list[int]:
        """The same contraction of the leftmost pair of least rank, for one long word."""
        n, rank = len(toks), self.rank
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(*rank[p], i, *p) for i in range(n - 1) if (p := (toks[i], toks[i + 1])) in rank]
        heap = [(r, i, m, a, b) for r, m, i, a, b in heap]
        heapq.heapify(heap)
        while heap:
            _, i, m, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or toks[i] != a or toks[j] != b:
                continue
            toks[i], alive[j], after[i] = m, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (q := (toks[x], toks[y])) in rank:
                    heapq.heappush(heap, (rank[q][0], x, rank[q][1], *q))
        return [t for t, k in zip(toks, alive) if k]

    def encode(self, texts: list[str | None]) -> list[list[str]]:
        """The words of each text, all of them known afterwards."""
        find = self.words
        cut = [find(t) if t else [] for t in texts]
        if len(self.known) > KEEP:
            self.known.clear()
        new = set(chain.from_iterable(cut)).difference(self.known)
        if new:
            self.learn(sorted(new))
        return cut


_ENCODERS: dict[int, Encoder] = {}


def _encoder(vocabulary: bytes) -> Encoder:
    """One encoder for all tasks of a worker process."""
    key = hash(vocabulary)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(vocabulary)
    return _ENCODERS[key]


def _vocabulary(df: DataFrame, vocab_dir: str):
    with open(os.path.join(vocab_dir, VOCAB), "rb") as f:  # a fixed file of 1.5 MB
        return df.sparkSession.sparkContext.broadcast(f.read())


def token_ids(docs: DataFrame, key: str = "doc_id", text: str = "text", vocab_dir: str = VOCAB_DIR) -> DataFrame:
    """(key, ids): the ids of each row's text, without special tokens."""
    shared, kind = _vocabulary(docs, vocab_dir), docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared.value)
        for batch in batches:
            cut = enc.encode(batch.column(1).to_pylist())
            known, flat, ends = enc.known, [], [0]
            for ws in cut:
                for w in ws:
                    flat += known[w]
                ends.append(len(flat))
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], [key, "ids"])

    return spread(docs.select(key, text)).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decoded(encoded: DataFrame, key: str = "doc_id", ids: str = "ids", vocab_dir: str = VOCAB_DIR) -> DataFrame:
    """(key, text) of rows of ids; no ids give an empty text."""
    shared, kind = _vocabulary(encoded, vocab_dir), encoded.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):  # a bounded number of rows to a query
                part = batch.slice(a, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(enc.decode(part.column(1)), pa.string())], [key, "text"])

    return encoded.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")


def token_counts(docs: DataFrame, keep: list[str], text: str = "text", vocab_dir: str = VOCAB_DIR) -> DataFrame:
    """``keep`` columns and n_tokens of each row's text, 0 for null and empty text."""
    shared = _vocabulary(docs, vocab_dir)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(shared.value)
        for batch in batches:
            cut = enc.encode(batch.column(len(keep)).to_pylist())
            n = [sum(map(len, map(enc.known.__getitem__, ws))) for ws in cut]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(n, pa.int64())], [*keep, "n_tokens"])

    return spread(docs.select(*keep, F.col(text).alias("__text"))).mapInArrow(run, f"{schema}, n_tokens bigint")
