"""Evaluation texts leaking into training text (problem 7).

Method: greedy string tiling. Windows of ``seed_words`` words of the evaluation items are hashed by a Karp-Rabin rolling
hash; a document's words roll through the same hash and join these seeds. From the seeds the longest matches are grown,
and again and again the longest non-overlapping match is marked in both texts until none of ``seed_words`` is left. The
marked words, over the words of the item, are its coverage. A document holds an item if one match has ``min_words`` words,
or if the coverage reaches ``min_coverage``, which also finds passages that were put in another order or cut up.

The items are the stated query set: they are looked up in blocks of at most ``block_chars`` characters, each of which is
broadcast and indexed once in a worker; the documents are read once a block, and nothing is collected but the items. The
documents are shuffled only where they are a small input of a few files (``session.spread``).

Words are maximal runs of letters and digits, compared without regard to case. Defined results: null, empty and
blank texts and items of fewer than ``seed_words`` words match nothing; repeated rows of a document or an item give
one row; rows with a null id are left out; empty tables give an empty table; other columns are not read.
"""

from __future__ import annotations

import re
import uuid
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from corpuskit.llm.arrow import small_batches
from corpuskit.session import spread

MIN_WORDS = 13
COVERAGE_SEED, MIN_COVERAGE = 5, 0.8
BLOCK_CHARS = 16 << 20
_WORD = re.compile(r"[^\W_]+")
_BASE = np.uint64(0x100000001B3)


def words(text: str | None) -> list[str]:
    """The words of a text, case folded."""
    return [w.casefold() for w in _WORD.findall(text)] if text else []


class _WordIds(dict):
    """Ids of words as they are written; -1 for words of no item."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self._known = known

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        at = self[word] = self._known.get(word.casefold(), -1)
        return at


def rolling(ids: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2^64) of all windows of ``width`` ids."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = ids.astype(np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(7))) * np.uint64(0x9E3779B97F4A7C15)
        h = np.zeros(n, np.uint64)
        for k in range(width):
            h = h * _BASE + x[k : k + n]
    return h


class Seeds:
    """The seed index of a block of items."""

    def __init__(self, items: list[tuple], min_words: int):
        self.min_words = min_words
        self.known: dict[str, int] = {}
        self.ids: list = []
        self.words: list[np.ndarray] = []
        hashes, owner, place = [], [], []
        for item, text in items:
            w = words(text)
            if len(w) < min_words:
                continue
            seq = np.array([self.known.setdefault(x, len(self.known)) for x in w], np.int64)
            h = rolling(seq, min_words)
            hashes.append(h)
            owner.append(np.full(len(h), len(self.ids), np.int64))
            place.append(np.arange(len(h)))
            self.ids.append(item)
            self.words.append(seq)
        h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        order = np.argsort(h, kind="stable")
        self.hash = h[order]
        self.owner = (np.concatenate(owner) if owner else np.zeros(0, np.int64))[order]
        self.place = (np.concatenate(place) if place else np.zeros(0, np.int64))[order]

    def matches(self, doc: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """For each item that shares a window: its maximal common runs as (length, doc position, item position)."""
        h = rolling(doc, self.min_words)
        if not len(h) or not len(self.hash):
            return {}
        lo = np.searchsorted(self.hash, h, "left")
        at = np.flatnonzero((lo < len(self.hash)) & (self.hash[np.minimum(lo, len(self.hash) - 1)] == h))
        runs: dict[int, dict[int, list[list[int]]]] = {}
        for p in at.tolist():
            k = int(lo[p])
            while k < len(self.hash) and self.hash[k] == h[p]:
                item, q = int(self.owner[k]), int(self.place[k])
                k += 1
                diagonal = runs.setdefault(item, {}).setdefault(p - q, [])
                if diagonal and diagonal[-1][1] >= p:
                    continue  # this window lies in a run already grown
                seq = self.words[item]
                n = 0
                while p + n < len(doc) and q + n < len(seq) and doc[p + n] == seq[q + n]:
                    n += 1
                if n >= self.min_words:  # false for a mere collision of hashes
                    diagonal.append([p, p + n - self.min_words])
        return {
            item: [(e - s + self.min_words, s, s - d) for d, spans in by.items() for s, e in spans]
            for item, by in runs.items()
            if any(by.values())
        }


def tile(matches: list[tuple[int, int, int]], min_words: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: the longest match first, clipped to what is not marked yet in either text."""
    import heapq

    heap = [(-n, p, q) for n, p, q in matches]
    heapq.heapify(heap)
    marked: list[list[tuple[int, int]]] = [[], []]
    tiles = []

    def free(spans, start, n):
        """Unmarked parts of start .. start + n, as offsets."""
        parts, at = [], start
        k = max(0, bisect_right(spans, (start, 1 << 60)) - 1)
        while k < len(spans) and spans[k][0] < start + n:
            s, e = spans[k]
            if s > at:
                parts.append((at - start, s - start))
            at = max(at, e)
            k += 1
        if at < start + n:
            parts.append((at - start, n))
        return parts

    while heap:
        n, p, q = heapq.heappop(heap)
        n = -n
        one, two = free(marked[0], p, n), free(marked[1], q, n)
        if one == [(0, n)] and two == [(0, n)]:
            tiles.append((n, p, q))
            for spans, at in zip(marked, (p, q)):
                spans.insert(bisect_right(spans, (at, at + n)), (at, at + n))
            continue
        for a, b in one:
            for c, d in two:
                s, e = max(a, c), min(b, d)
                if e - s >= min_words:
                    heapq.heappush(heap, (-(e - s), p + s, q + s))
    return tiles


_built: dict[str, Seeds] = {}


def _index(key: str, items, seed_words: int) -> Seeds:
    """The index of a block, built once in a worker; the one before it is let go."""
    if key not in _built:
        _built.clear()
        _built[key] = Seeds(items.value, seed_words)
    return _built[key]


_OUT = ["doc", "item", "tiles", "longest", "covered", "words"]


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    min_words: int = MIN_WORDS,
    block_chars: int = BLOCK_CHARS,
    seed_words: int | None = None,
    min_coverage: float | None = None,
) -> DataFrame:
    """One row per document and item that share ``min_words`` consecutive words, or tiles of ``seed_words`` (by default
    min_words) that cover ``min_coverage`` of the item: doc_id, item_id, n_tiles, longest_words, covered_words, item_words,
    coverage (share of the item's words that are marked)."""
    seed = min_words if seed_words is None else seed_words
    if seed > min_words:
        raise ValueError("seeds may not be longer than the matches asked for")
    spark = docs.sparkSession
    doc_type, item_type = docs.schema[doc_id].dataType.simpleString(), items.schema[item_id].dataType.simpleString()
    kept = items.select(F.col(item_id).alias("i"), F.col(item_text).alias("t")).filter("i is not null and t is not null").distinct()
    size = kept.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-size // block_chars))
    rows = spread(docs.select(F.col(doc_id).alias("id"), F.col(text_col).alias("text")).filter(f"id is not null and length(text) >= {2 * seed - 1}"))
    item_kind = to_arrow_type(items.schema[item_id].dataType)
    schema = f"doc {doc_type}, item {item_type}, tiles long, longest long, covered long, words long"
    out = None
    for block in range(blocks):
        part = kept.filter(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == block) if blocks > 1 else kept
        seeds = spark.sparkContext.broadcast([(r.i, r.t) for r in part.collect()])

        def run(batches, seeds=seeds, key=uuid.uuid4().hex):
            index = _index(key, seeds, seed)
            get = _WordIds(index.known).__getitem__
            for batch in small_batches(batches, "text"):
                ids, cols = batch.column("id"), [[] for _ in range(6)]
                for i, text in enumerate(batch.column("text").to_pylist()):
                    found = _WORD.findall(text)
                    seq = np.fromiter(map(get, found), np.int64, len(found))
                    # words of no item never match; each gets a number of its own
                    seq[seq < 0] = -2 - np.flatnonzero(seq < 0)
                    for item, runs in index.matches(seq).items():
                        lengths = [t[0] for t in tile(runs, seed)]
                        longest, covered, n = max(lengths), sum(lengths), len(index.words[item])
                        if longest >= min_words or (min_coverage is not None and covered >= min_coverage * n):
                            for col, v in zip(cols, (i, item, len(lengths), longest, covered, n)):
                                col.append(v)
                item = pa.array([index.ids[k] for k in cols[1]], item_kind)
                rest = [pa.array(c, pa.int64()) for c in cols[2:]]
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(cols[0], pa.int64())), item, *rest], _OUT)

        found = rows.mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    best = out.groupBy("doc", "item").agg(F.max(F.struct("covered", "tiles", "longest", "words")).alias("m"))
    return best.select(
        F.col("doc").alias(doc_id),
        F.col("item").alias(item_id),
        F.col("m.tiles").alias("n_tiles"),
        F.col("m.longest").alias("longest_words"),
        F.col("m.covered").alias("covered_words"),
        F.col("m.words").alias("item_words"),
        (F.col("m.covered") / F.col("m.words")).alias("coverage"),
    )
