"""Near-duplicate texts with small edits (problem 2).

Similarity: the text in lower case, letters, digits and white space only; the set of its substrings of three
characters (tokens); size of the intersection over that of the union.

Method: parity-sketch join. Two sets of similarity above t differ in at most d = (a + b)(1 - t)/(1 + t) tokens.
Tokens are hashed into the bands of a sketch and XOR-ed there, so a token that only one set has changes one band:
the number of differing bands, and the Hamming distance of a bit sketch, bound the symmetric difference from below; the
bit sketch is 3.5 d bits wide, so that it tells sets of every size apart. Within a size band (sizes that can be similar)
the sketches are joined on equal bands; with d + 1 bands a pair cannot miss every one (``miss=0``). As the bands are
chosen by a random hash, fewer, wider bands do for all but a proven share ``miss`` of pairs exactly at the threshold (by
default one in a million, falling steeply above it), and they keep unrelated texts apart: that is what makes the join
feasible. Pairs whose sketches differ in more than d bits are dropped, the others are verified on the texts themselves.

Each text takes part once; records of one text are its members, so copies cost nothing. A text is known by its MD5; in the
join 64 bits of another hash stand for it, and every text that has them is verified, so texts of one hash are not mixed up.
Bands of different texts meet in tasks of bounded size: (size band, group of bands, split), the splits growing with the
table (``split_rows``); a text's sketch is in each task that gets one of its bands. Runs of one band value are compared in
the order of size by vector operations; only pairs that pass the sketch leave the task. No pair, partner or bucket is
capped.

Defined results: null texts, texts under ``min_chars`` and texts without any token have no similar record; null ids
are left out; repeated rows of one record count once; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re
from functools import lru_cache
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.operators.components import connected_components
from corpuskit.operators.joins import semi_join
from corpuskit.session import cut_lineage, spread

THRESHOLD = 0.85
MIN_CHARS = 200
MISS = 1e-6
SIZE_STEP = 1.38  # width of a size band
GROUPS = 4  # groups of bands of a size band, each a task
SPLIT_ROWS = 4_000_000  # rows of the table for each split of a group

_OTHER = re.compile(r"[^\w\s]|_")
_LOWER = bytes(range(256)).lower()
_DROP = bytes(i for i in range(128) if not (chr(i).isalnum() or chr(i).isspace()))


def normalise(text: str) -> str:
    """Lower case; letters, digits and white space only."""
    if text.isascii():
        return text.encode().translate(_LOWER, _DROP).decode("ascii")
    return _OTHER.sub("", text.lower())


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def tokens(text: str) -> np.ndarray:
    """The set of three-character substrings of a normalised text, as sorted exact codes."""
    c = _codes(text)
    return np.unique(c[:-2] | (c[1:-1] << np.uint64(21)) | (c[2:] << np.uint64(42))) if len(c) > 2 else np.zeros(0, np.uint64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common / (len(a) + len(b) - common)


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(31))
        x = x * np.uint64(0x7FB5D329728EA185)
        x = x ^ (x >> np.uint64(27))
        x = x * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def bands_for(d: int, miss: float) -> int:
    """Fewest bands of which d changes touch every one with a probability of at most ``miss``; d + 1 are sure."""
    for b in range(1, d + 1):
        # The bands' hits are negatively dependent, so the product bounds the chance that all are hit.
        if miss > 0 and b * log(max(1e-300, 1 - (1 - 1 / b) ** d)) <= log(miss):
            return b
    return d + 1


@lru_cache(maxsize=256)
def _layout(level: int, threshold: float, step: float, miss: float) -> tuple[int, int]:
    """Bands, and 64-bit words of the sketch, of the size band whose smaller sets have sizes in [step^level, step^(level + 1))."""
    top = ceil(step ** (level + 1))
    d = floor((top + top / threshold) * (1 - threshold) / (1 + threshold) + 1e-9)
    return bands_for(d, miss), max(2, ceil(3.5 * d / 64))


class _Sketcher:
    """Sketches of a batch of texts, as blocks of rows (one block a task of the join)."""

    def __init__(self, threshold: float, step: float, groups: int, splits: int, miss: float):
        self.threshold, self.step, self.groups, self.splits, self.miss = threshold, step, groups, splits, miss

    def blocks(self, ids: np.ndarray, texts: list[str]):
        norms = [normalise(t) for t in texts]
        lengths = np.array([len(x) for x in norms], np.int64)
        code = _codes("".join(norms))
        if len(code) < 3:
            return
        row = np.repeat(np.arange(len(norms)), lengths)
        inside = row[2:] == row[:-2]  # no token crosses from one text to the next
        full = _mix((code[:-2] | (code[1:-1] << np.uint64(21)) | (code[2:] << np.uint64(42)))[inside])
        owner = row[:-2][inside].astype(np.uint64)
        # One sort gives the distinct tokens of each text, and their bands in order, as bands come from the high bits.
        keyed = (owner << np.uint64(44)) | (full >> np.uint64(20))
        keyed.sort()
        keyed = keyed[np.concatenate(([True], keyed[1:] != keyed[:-1]))] if len(keyed) else keyed
        owner = (keyed >> np.uint64(44)).astype(np.int64)
        h = keyed & np.uint64((1 << 44) - 1)
        size = np.bincount(owner, minlength=len(norms))
        value = _mix(h)
        some = np.flatnonzero(size > 0)
        level = np.zeros(len(norms), np.int64)
        level[some] = np.floor(np.log(size[some]) / log(self.step) + 1e-9).astype(np.int64)
        # A set also joins the size band below its own if that holds sets small enough to be similar.
        for at in np.unique(level[some]).tolist():
            own = some[level[some] == at]
            yield from self._level(at, own, owner, h, value, ids, size)
            low = own[size[own] * self.threshold < self.step**at]
            if at > 0 and len(low):
                yield from self._level(at - 1, low, owner, h, value, ids, size)

    @staticmethod
    def _bits(place, h, n, words):
        """The parity of the tokens of each of n sets in each bit."""
        bits = words * 64
        bit = ((h & np.uint64(0xFFFFF)) * np.uint64(bits) >> np.uint64(20)).astype(np.int64)
        odd = np.bincount(place * bits + bit, minlength=n * bits).astype(np.uint8) & 1
        return np.packbits(odd.reshape(n, bits), axis=1)

    def _level(self, level, rows, owner, h, value, ids, size):
        bands, words = _layout(level, self.threshold, self.step, self.miss)
        place = np.full(len(size), -1, np.int64)
        place[rows] = np.arange(len(rows))
        mine = place[owner] >= 0
        at = place[owner[mine]]
        sketch = self._bits(at, h[mine], len(rows), words)
        cell = at * bands + ((h[mine] >> np.uint64(12)) * np.uint64(bands) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        keys = np.zeros(len(rows) * bands, np.uint64)
        keys[cell[starts]] = np.bitwise_xor.reduceat(value[mine], starts)
        keys = (_mix(keys) >> np.uint64(32)).astype(np.uint32).reshape(len(rows), bands)
        for g in range(self.groups):
            first, last = g * bands // self.groups, (g + 1) * bands // self.groups
            if first == last:
                continue
            part = keys[:, first:last]
            for s in range(self.splits):
                if self.splits == 1:
                    take, at, band, key = np.arange(len(rows)), b"", b"", np.ascontiguousarray(part.T).tobytes()
                else:
                    r, c = np.nonzero(part % self.splits == s)
                    if not len(r):
                        continue
                    take, at = np.unique(r, return_inverse=True)
                    at, band, key = at.astype(np.uint32).tobytes(), c.astype(np.uint16).tobytes(), part[r, c].tobytes()
                who = rows[take]
                yield (level * self.groups + g) * self.splits + s, last - first, words, ids[who].tobytes(), size[who].astype(np.uint32).tobytes(), sketch[take].tobytes(), at, band, key


_BLOCK = "part int, bands int, words int, ids binary, sizes binary, sketches binary, places binary, band binary, keys binary"


def _sketch_batches(sketcher: _Sketcher):
    names = [f.split()[0] for f in _BLOCK.split(", ")]
    kinds = [*[pa.int32()] * 3, *[pa.binary()] * 6]

    def run(batches):
        seen: set[bytes] = set()  # copies of a text within this partition
        for batch in batches:
            fresh = []
            for i, x in enumerate(batch.column("k").to_pylist()):
                if x not in seen:
                    seen.add(x)
                    fresh.append(i)
            take = pa.array(fresh, pa.int64())
            texts = batch.column("text").take(take).to_pylist()
            ids = batch.column("h").take(take).to_numpy()
            at = 0
            while at < len(texts):  # at most about 4M characters, and 2^20 rows, at a time
                stop, chars = at, 0
                while stop < len(texts) and (stop == at or chars + len(texts[stop]) <= 4_000_000):
                    chars += len(texts[stop])
                    stop += 1
                out = list(sketcher.blocks(ids[at:stop], texts[at:stop]))
                at = stop
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def _join_blocks(threshold: float):
    """Pairs of one task: equal band values, sizes that can be similar, sketches that differ in d bits at most."""
    factor = (1 - threshold) / (1 + threshold)

    def run(table: pa.Table) -> pa.Table:
        blocks = table.to_pylist()
        ids = np.concatenate([np.frombuffer(b["ids"], np.int64) for b in blocks])
        sizes = np.concatenate([np.frombuffer(b["sizes"], np.uint32) for b in blocks]).astype(np.int64)
        sketches = np.concatenate([np.frombuffer(b["sketches"], np.uint64).reshape(-1, blocks[0]["words"]) for b in blocks])
        offsets = np.cumsum([0, *(len(b["ids"]) // 8 for b in blocks)])
        # Rows of one hash, size and sketch are copies; different texts of one hash stay apart.
        _, first = np.unique(_mix(sketches[:, 0] + sizes.astype(np.uint64)) ^ ids.view(np.uint64), return_index=True)
        fresh = np.zeros(len(ids), bool)
        fresh[first] = True  # copies from other partitions
        found = []
        for band in range(blocks[0]["bands"]):
            who, keys = [], []
            for b, off in zip(blocks, offsets):
                key = np.frombuffer(b["keys"], np.uint32)
                if b["places"]:
                    of = np.frombuffer(b["band"], np.uint16) == band
                    who.append(np.frombuffer(b["places"], np.uint32)[of].astype(np.int64) + off)
                    keys.append(key[of])
                else:
                    n = len(b["ids"]) // 8
                    who.append(np.arange(off, off + n))
                    keys.append(key[band * n : (band + 1) * n])
            who, keys = np.concatenate(who), np.concatenate(keys)
            keep = fresh[who]
            who, keys = who[keep], keys[keep]
            order = np.lexsort((sizes[who], keys))
            who, keys = who[order], keys[order]
            n = sizes[who]
            at, k = np.arange(len(who)), 1
            while len(at):
                at = at[at + k < len(who)]
                # Sizes rise within a run: once one is too large, so are those after it.
                at = at[(keys[at] == keys[at + k]) & (n[at] >= threshold * n[at + k])]
                for s in range(0, len(at), 1 << 18):
                    one, two = who[at[s : s + (1 << 18)]], who[at[s : s + (1 << 18)] + k]
                    apart = np.bitwise_count(sketches[one] ^ sketches[two]).sum(axis=1, dtype=np.int64)
                    ok = apart <= (sizes[one] + sizes[two]) * factor + 1e-9
                    ok &= ids[one] != ids[two]
                    if ok.any():
                        found.append(np.stack((ids[one[ok]], ids[two[ok]])))
                k += 1
        pairs = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        pairs = np.unique(np.sort(pairs, axis=0), axis=1)
        return pa.table({"a": pa.array(pairs[0]), "b": pa.array(pairs[1])})

    return run


def _verify(threshold: float):
    def run(batches):
        cache: dict[bytes, np.ndarray] = {}

        def of(key, text):
            got = cache.get(key)
            if got is None:
                if len(cache) > 20_000:
                    cache.clear()
                got = cache[key] = tokens(normalise(text))
            return got

        for batch in batches:
            a, b, ta, tb = (batch.column(c).to_pylist() for c in ("a", "b", "ta", "tb"))
            score = [similarity(of(x, s), of(y, t)) for x, y, s, t in zip(a, b, ta, tb)]
            keep = [i for i, x in enumerate(score) if x > threshold]
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take), pa.array([score[i] for i in keep], pa.float64())], ["a", "b", "similarity"])

    return run


class NearDuplicates:
    """The join of one table with itself: ``members`` (id, k: the MD5 of its text), ``links`` (a, b, similarity) between
    different texts, and from them ``pairs`` of records and ``classes`` of records."""

    def __init__(
        self,
        df: DataFrame,
        id_col: str = "record_id",
        text_col: str = "code",
        threshold: float = THRESHOLD,
        min_chars: int = MIN_CHARS,
        miss: float = MISS,
        split_rows: int = SPLIT_ROWS,
        h: Column | None = None,
    ):
        self.threshold = threshold
        rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(f"id is not null and length(text) >= {min_chars}")
        self.rows = rows.select("id", "text", (F.xxhash64("text") if h is None else h).alias("h"), F.unhex(F.md5(F.col("text").cast("binary"))).alias("k"))
        self.members = self.rows.select("id", "k").distinct()
        splits = max(1, ceil(df.count() / split_rows))
        sketcher = _Sketcher(threshold, SIZE_STEP, GROUPS, splits, miss)
        blocks = spread(self.rows.select("h", "k", "text")).mapInArrow(_sketch_batches(sketcher), _BLOCK)
        candidates = blocks.groupBy("part").applyInArrow(_join_blocks(threshold), "a long, b long").distinct()
        self.candidates = cut_lineage(candidates)
        self.links = cut_lineage(self._verified())

    def _verified(self) -> DataFrame:
        both = self.candidates.select(F.explode(F.array("a", "b")).alias("h")).distinct()
        texts = semi_join(self.rows.select("h", "k", "text"), both, ["h"]).groupBy("h", "k").agg(F.any_value("text").alias("text"))
        one, two = texts.withColumnsRenamed({"h": "ha", "k": "a", "text": "ta"}), texts.withColumnsRenamed({"h": "hb", "k": "b", "text": "tb"})
        found = self.candidates.withColumnsRenamed({"a": "ha", "b": "hb"})
        return found.join(one, "ha").join(two, "hb").select("a", "b", "ta", "tb").mapInArrow(_verify(self.threshold), "a binary, b binary, similarity double")

    def pairs(self) -> DataFrame:
        """id_a < id_b of all similar records, copies included."""
        m = self.members
        near = self.links.join(m.select(F.col("k").alias("a"), F.col("id").alias("x")), "a").join(m.select(F.col("k").alias("b"), F.col("id").alias("y")), "b")
        shared = m.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        has_token = F.length(F.regexp_replace("text", r"[^\p{L}\p{N}\s]", "")) > 2
        texts = semi_join(self.rows, cut_lineage(shared.select("k")), ["k"]).filter(has_token).select("id", "k").distinct()
        same = texts.select("k", F.col("id").alias("x")).join(texts.select("k", F.col("id").alias("y")), "k").filter("x < y")
        both = near.select("x", "y").unionByName(same.select("x", "y"))
        return both.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).filter("id_a < id_b").distinct()

    def classes(self) -> DataFrame:
        """One row per record: id, class_id (least id of the class), copies (records of its text), links (similar records)."""
        count = self.members.groupBy("k").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
        edges = self.links.select("a", "b").union(self.links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        linked = edges.join(count.select(F.col("k").alias("b"), "copies"), "b").groupBy("a").agg(F.sum("copies").alias("others"))
        label = connected_components(self.links)
        text = (
            count.join(label, count.k == label.node, "left")
            .join(linked, count.k == linked.a, "left")
            .select("k", "copies", "least", F.coalesce("component", "k").alias("component"), F.coalesce("others", F.lit(0)).alias("others"))
        )
        ids = text.groupBy("component").agg(F.min("least").alias("class_id"))
        return (
            self.members.join(text.join(ids, "component"), "k")
            .select("id", "class_id", "copies", (F.col("copies") - 1 + F.col("others")).alias("links"))
        )
