"""Pairs of short texts with alike trigram sets, found inside a task: numpy over flat arrays, no Spark."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Trigrams are counted by so many hash values; their order needs no more.
BUCKETS = 1 << 16
#: Sets that are compared at once, as rows of a matrix.
_BLOCK = 512
#: Pairs of records in a batch, about.
_OUT = 1 << 17


def pieces(batch: pa.RecordBatch, text_col: str, most: int = 1 << 22):
    """The rows in slices of about ``most`` bytes of text (one row at least)."""
    step = max(1, batch.num_rows * most // max(1, batch.column(text_col).nbytes))
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Row and code of each text's trigrams, each once, in order. A trigram is three characters, so 63 bits hold it."""
    row = np.repeat(np.arange(len(texts)), np.fromiter(map(len, texts), np.int64, len(texts)))
    c = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
    code, own = c[:-2] | c[1:-1] << 21 | c[2:] << 42, row[:-2] == row[2:]
    row, code = row[:-2][own], code[own]
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    return row[new], code[new]


def bucket(codes: np.ndarray) -> np.ndarray:
    return (codes.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(48)).astype(np.int64)


def _need(n: np.ndarray, threshold: float) -> np.ndarray:
    """Trigrams that a set of n has in common with any that is alike."""
    return np.maximum(1, np.ceil(n * threshold)).astype(np.int64)


def _first(row: np.ndarray, per_row: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Which entries are among the first ``most`` of their row; entries lie by rows."""
    return np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row) < most[row]


def prefixes(texts: list[str], rank: np.ndarray, threshold: float, short: int) -> list[np.ndarray]:
    """Of each text the trigrams, rarest first, of which it shares one with any text alike; none of texts that have more
    than ``short`` trigrams. ``rank`` is by bucket."""
    row, code = trigrams(texts)
    order = np.lexsort((code, rank[bucket(code)], row))
    n = np.bincount(row, minlength=len(texts))
    most = np.where(n > short, 0, n - _need(n, threshold) + 1)
    return np.split(code[order][_first(row, n, most)], np.cumsum(np.minimum(n, most))[:-1])


class _Sets(NamedTuple):
    at: np.ndarray  # the set's row
    n: np.ndarray  # its size
    starts: np.ndarray  # of its trigrams in gram, and one more
    gram: np.ndarray  # numbers under len(early)

    def take(self, some: np.ndarray) -> _Sets:
        size = (self.starts[1:] - self.starts[:-1])[some]
        starts = np.concatenate([[0], np.cumsum(size)])
        return _Sets(self.at[some], self.n[some], starts, self.gram[np.arange(starts[-1]) + np.repeat(self.starts[some] - starts[:-1], size)])


def _compared(s: _Sets, early: np.ndarray, threshold: float):
    """As _alike, each with each."""
    s = s.take(np.argsort(s.n, kind="stable"))
    m, far = len(s.at), s.n.max() + 1.0
    cuts = [(lo, min(m, lo + _BLOCK)) for lo in range(0, m, _BLOCK)]
    rows = np.repeat(np.arange(m), np.diff(s.starts))
    for k, (lo, hi) in enumerate(cuts):
        ga, ra = s.gram[s.starts[lo] : s.starts[hi]], rows[s.starts[lo] : s.starts[hi]] - lo
        ca = np.bincount(ga, minlength=len(early))
        for lo2, hi2 in cuts[k:]:
            if s.n[hi - 1] < s.n[lo2] * threshold * (1 - 1e-9):
                break
            gb, rb = s.gram[s.starts[lo2] : s.starts[hi2]], rows[s.starts[lo2] : s.starts[hi2]] - lo2
            cb = ca if lo == lo2 else np.bincount(gb, minlength=len(early))
            full = (ca == hi - lo) & (cb == hi2 - lo2)
            if (full & early).any():
                continue
            cols = (ca > 1 if lo == lo2 else (ca > 0) & (cb > 0)) & ~full
            place, width = np.cumsum(cols) - 1, int(cols.sum())
            x, y = np.zeros((hi - lo, width), np.float32), np.zeros((hi2 - lo2, width), np.float32)
            a, b = cols[ga], cols[gb]
            x[ra[a], place[ga[a]]] = np.where(early[ga[a]], -far, 1)  # a common early one makes the count negative
            y[rb[b], place[gb[b]]] = 1
            common = x @ y.T
            common += np.count_nonzero(full)
            i, j = np.nonzero(common * np.float32(1 + threshold) > np.float32(threshold) * (s.n[lo:hi, None] + s.n[None, lo2:hi2]).astype(np.float32) - np.float32(0.01))
            if lo == lo2:
                i, j = i[i < j], j[i < j]
            c = common[i, j].astype(np.int64)
            score = c / (s.n[lo + i] + s.n[lo2 + j] - c)
            keep = score > threshold
            yield s.at[lo + i[keep]], s.at[lo2 + j[keep]], score[keep]


def _alike(s: _Sets, early: np.ndarray, threshold: float):
    """Rows and similarity of the sets that are alike and have no early trigram in common.

    Many sets are first parted by the same prefix rule, with the trigrams in the order of their frequency among these sets.
    """
    m = len(s.at)
    if m < 2:
        return
    row, late = np.repeat(np.arange(m), np.diff(s.starts)), ~early[s.gram]
    left, need = np.bincount(row[late], minlength=m), _need(s.n, threshold)
    if (left < need).any():
        yield from _alike(s.take(np.flatnonzero(left >= need)), early, threshold)
        return
    df = np.bincount(s.gram, minlength=len(early))
    if (early & (df == m)).any():
        return
    if m > _BLOCK:
        r, g = row[late], s.gram[late]
        order = np.lexsort((g, df[g], r))
        g, some = g[order], _first(r, left, left - need + 1)
        r, g = r[some], g[some]
        order = np.argsort(g, kind="stable")
        r, g = r[order], g[order]
        edges = np.concatenate([[0], np.flatnonzero(g[1:] != g[:-1]) + 1, [len(g)]])
        if (np.diff(edges).astype(float) ** 2).sum() < m * m / 2:
            for lo, hi in zip(edges[:-1], edges[1:]):
                if hi - lo > 1:
                    part = s.take(r[lo:hi])
                    own, gram = np.unique(part.gram, return_inverse=True)
                    h = g[lo]
                    yield from _alike(part._replace(gram=gram), early[own] | (df[own] < df[h]) | (df[own] == df[h]) & (own < h), threshold)
            return
    yield from _compared(s, early, threshold)


def _whole(batches, key: str):
    """Tables with all rows of each of their keys; rows are in the order of the key."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy()
        last = int(np.searchsorted(k, k[-1]))
        if held and not last and held[-1].column(key)[-1].as_py() == k[-1]:
            held.append(batch)
            continue
        if held or last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held)


def _of_records(i: np.ndarray, j: np.ndarray, score: np.ndarray, starts: np.ndarray, ids: np.ndarray):
    """The pairs of rows as pairs of their records, in arrays of about _OUT."""
    size = np.diff(starts)
    each = size[i] * size[j]
    done = np.cumsum(each)
    lo = 0
    while lo < len(i):
        hi = max(lo + 1, int(np.searchsorted(done, (done[lo - 1] if lo else 0) + _OUT, "right")))
        n = each[lo:hi]
        pair = np.repeat(np.arange(lo, hi), n)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        a, b = ids[starts[i[pair]] + k // size[j[pair]]], ids[starts[j[pair]] + k % size[j[pair]]]
        keep = np.where(i[pair] == j[pair], a < b, a != b).astype(bool)  # the records of one row meet twice
        a, b = a[keep], b[keep]
        yield np.minimum(a, b), np.maximum(a, b), score[pair][keep]
        lo = hi


def pairs(batches, rank: np.ndarray, threshold: float):
    """id_a < id_b and similarity, from batches of g (in order), t and ids: texts that have g in their prefix and the ids of
    their records. A pair is given where g is the first trigram that its texts have in common, so once."""
    for part in _whole(batches, "g"):
        g = part.column("g").to_numpy()
        many = part.column("ids").combine_chunks()
        ids, records = many.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(many.value_lengths().to_numpy(zero_copy_only=False))])
        row, code = trigrams(part.column("t").to_pylist())
        n = np.bincount(row, minlength=len(g))
        starts = np.concatenate([[0], np.cumsum(n)])
        edges = [0, *(np.flatnonzero(g[1:] != g[:-1]) + 1), len(g)]
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi - lo == 1 and records[hi] - records[lo] == 1:
                continue
            own, gram = np.unique(code[starts[lo] : starts[hi]], return_inverse=True)
            order, at = rank[bucket(own)], rank[bucket(g[lo : lo + 1])][0]
            early = (order < at) | (order == at) & (own < g[lo])
            s = _Sets(np.arange(lo, hi), n[lo:hi], starts[lo : hi + 1] - starts[lo], gram)
            alone = np.bincount(row[starts[lo] : starts[hi]] - lo, early[gram], hi - lo) == 0
            copies = lo + np.flatnonzero(alone & (np.diff(records[lo : hi + 1]) > 1) & (threshold < 1))
            yield from _of_records(copies, copies, np.ones(len(copies)), records, ids)
            for i, j, score in _alike(s, early, threshold):
                yield from _of_records(i, j, score, records, ids)
