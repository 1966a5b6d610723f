"""Splitting oversized texts at natural boundaries (problem 8).

Method: content-defined chunking. A rolling hash over the pre-tokens sets landmarks; a piece ends at the natural
boundary nearest to the first landmark that leaves it at least ``min_tokens`` and at most ``max_tokens`` long: a blank
line, line end or sentence end within ``snap`` tokens, else white space, else any place between tokens. Where there is no
landmark, the longest piece takes its place. Cuts depend on the text around them only, so an edit alters the pieces beside
it and the later cuts fall on the same landmarks again.

Piece k+1 starts ``overlap`` tokens of the text's encoding before the end of piece k, within a word if need be; only where
that point lies inside a character (of several tokens) the overlap grows to the character's start. A long run without any
boundary is cut between its tokens. Any part of an encoding that is cut between tokens encodes to the same tokens by
itself, so a piece has as many tokens as it counts (fewer where white space at its end merges).

Defined results: null, empty and blank texts and texts of at most ``max_tokens`` tokens give no piece (they are
not oversized); repeated rows of an id and text give the same pieces once each time; null ids are kept; an empty
table gives an empty table; other columns are not read. ``start_char`` and ``end_char`` are offsets in characters,
and ``start_token``/``end_token`` in tokens of the whole text's encoding.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskit.llm.arrow import small_batches
from corpuskit.llm.bpe import BYTE_BPE_50K, TOKENIZER_DIR, Bpe, load_bpe
from corpuskit.session import spread

MAX_TOKENS = 2048
OVERLAP_TOKENS = 128
MIN_TOKENS = 1024
LANDMARK_WINDOW = 8
LANDMARK_EVERY = 128
SNAP_TOKENS = 256
SEGMENT_CHARS = 1 << 20
_SENTENCE = re.compile(r"[.!?。！？…]['\")\]]*$")


def _ranks(pieces: list[str], line: bool, after_all: str) -> tuple[np.ndarray, bool]:
    """Rank of the boundary after each pre-token: 4 blank line, 3 line end, 2 sentence end, 1 white space, 0 other; and
    whether the last line holds nothing but white space so far. ``line`` is that of the text before, ``after_all`` what follows."""
    out = np.zeros(len(pieces), np.int8)
    for i, piece in enumerate(pieces):
        after = pieces[i + 1] if i + 1 < len(pieces) else after_all
        ends = piece[-1] == "\n" or piece[-1] == "\r"
        if ends:
            out[i] = 4 if line or piece.count("\n") > 1 else 3
            line = True
        elif not piece.isspace():
            line = False
            if after[:1].isspace():
                out[i] = 2 if _SENTENCE.search(piece) else 1
    return out, line


def _is_landmark(h: np.ndarray, window: int, every: int) -> np.ndarray:
    """Whether the rolling hash of the last ``window`` hashes is a landmark, at each place but the first window - 1."""
    n = len(h) - window + 1
    if n <= 0:
        return np.zeros(0, bool)
    roll = np.zeros(n, np.uint64)
    factor = np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        weight = np.uint64(1)
        for k in range(window):
            roll += h[window - 1 - k : window - 1 - k + n] * weight
            weight = weight * factor
        roll ^= roll >> np.uint64(29)
        roll *= np.uint64(0xBF58476D1CE4E5B9)
        roll ^= roll >> np.uint64(32)
    return roll % np.uint64(every) == 0


def _parts(bpe: Bpe, piece: str) -> tuple[list[str], list[int]]:
    """A pre-token cut at its tokens, as far as they end between characters, and the tokens of each part."""
    raw, at, parts, counts = piece.encode("utf-8", "surrogatepass"), 0, [], []
    start = held = 0
    for token in bpe.encode(piece):
        at += len(bpe.decode([token]))
        held += 1
        if at >= len(raw) or raw[at] & 0xC0 != 0x80:
            parts.append(raw[start:at].decode("utf-8", "surrogatepass"))
            counts.append(held)
            start, held = at, 0
    return parts, counts


def _segments(text: str, chars: int):
    """The text in slices of about ``chars`` that end where a pre-token ends for sure: white space after another character."""
    at = 0
    while at < len(text):
        m = _SURE.search(text, at + chars) if at + chars < len(text) else None
        stop = m.start() if m else len(text)
        yield text[at:stop], text[stop : stop + 1]
        at = stop


_SURE = re.compile(r"(?<=[^\s\x1c-\x1f\x85])[ \n]")


class _Scan:
    """Boundaries of a text in order: tokens and characters before each, its rank, and whether it is a landmark.

    Pre-tokens are held for a segment of the text at a time, their places as numbers.
    """

    def __init__(self, bpe: Bpe, text: str, window: int, every: int, part_tokens: int, segment: int, known: tuple[list, list] | None = None):
        tokens, chars, ranks, marks = [], [], [], []
        line, tail, seen = False, np.zeros(0, np.uint64), 0
        for part, after in _segments(text, segment):
            pieces, counts = known or (bpe.pieces(part), None)
            n_tokens = np.array(counts or bpe.piece_counts(pieces), np.int64)
            large = np.flatnonzero(n_tokens > part_tokens).tolist()
            if large:
                whole, old, done, new = pieces, n_tokens, 0, []
                pieces = []
                for k in large:
                    ps, ns = _parts(bpe, whole[k])
                    pieces += whole[done:k]
                    pieces += ps
                    new += [old[done:k], ns]
                    done = k + 1
                pieces += whole[done:]
                n_tokens = np.concatenate([*new, old[done:]]).astype(np.int64)
            tokens.append(n_tokens)
            chars.append(np.fromiter(map(len, pieces), np.int64, len(pieces)))
            rank, line = _ranks(pieces, line, after)
            ranks.append(rank)
            h = np.fromiter((zlib.crc32(p.encode("utf-8", "surrogatepass")) for p in pieces), np.uint64, len(pieces))
            both = np.concatenate((tail, h))
            hit = _is_landmark(both, window, every)
            marks.append(np.flatnonzero(hit) + window - 1 - len(tail) + seen + 1)
            tail, seen = both[max(0, len(both) - window + 1) :], seen + len(pieces)
        self.token = np.concatenate(([0], np.cumsum(np.concatenate(tokens))))
        self.char = np.concatenate(([0], np.cumsum(np.concatenate(chars))))
        self.rank = np.concatenate(([0], *ranks))
        self.marks = np.concatenate(marks)

    def place(self, bpe: Bpe, text: str, token: int) -> tuple[int, int]:
        """The last place between two characters that has at most ``token`` tokens before it: (characters, tokens)."""
        k = int(np.searchsorted(self.token, token, "right")) - 1
        char, at = int(self.char[k]), int(self.token[k])
        if at < token:
            for part, n in zip(*_parts(bpe, text[char : int(self.char[k + 1])])):
                if at + n > token:
                    break
                char, at = char + len(part), at + n
        return char, at


def split_text(
    bpe: Bpe,
    text: str,
    max_tokens: int = MAX_TOKENS,
    overlap: int = OVERLAP_TOKENS,
    min_tokens: int = MIN_TOKENS,
    window: int = LANDMARK_WINDOW,
    every: int = LANDMARK_EVERY,
    snap: int = SNAP_TOKENS,
    segment: int = SEGMENT_CHARS,
) -> list[tuple[int, int, int, int]]:
    """Pieces as (start_char, end_char, start_token, end_token); none for a text that is not oversized."""
    if not text or len(text.encode("utf-8", "surrogatepass")) <= max_tokens:
        return []  # every token is a byte at least
    known = None
    if len(text) <= segment:
        pieces = bpe.pieces(text)
        counts = bpe.piece_counts(pieces)
        known = pieces, counts
        if sum(counts) <= max_tokens:
            return []
    scan = _Scan(bpe, text, window, every, max(1, min(8, max_tokens // 8)), segment, known)
    token, char, rank, marks = scan.token, scan.char, scan.rank, scan.marks
    total = int(token[-1])
    if total <= max_tokens:
        return []
    # Natural boundaries come first, then white space, then the rest.
    tier = np.select([rank >= 2, rank == 1], [0, 1], 2)
    out, start, first = [], 0, 0
    while total - first > max_tokens:
        low = int(np.searchsorted(token, first + max(min_tokens, overlap + 1), "left"))
        high = int(np.searchsorted(token, first + max_tokens, "right")) - 1
        low = min(max(low, int(np.searchsorted(token, first, "right"))), high)
        here = marks[np.searchsorted(marks, low) : np.searchsorted(marks, high, "right")]
        goal = token[here[0]] if len(here) else token[high]
        at = np.arange(low, high + 1)
        away = np.abs(token[at] - goal)
        near, away = at[away <= snap], away[away <= snap]
        cut = int(near[np.lexsort((near, -rank[near], away, tier[near]))[0]])
        out.append((start, int(char[cut]), first, int(token[cut])))
        after = scan.place(bpe, text, int(token[cut]) - overlap)
        start, first = after if after[1] > first else (int(char[cut]), int(token[cut]))
    out.append((start, int(char[-1]), first, total))
    return out


def split_oversized(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    overlap: int = OVERLAP_TOKENS,
    min_tokens: int = MIN_TOKENS,
    directory: str = TOKENIZER_DIR,
    name: str = BYTE_BPE_50K,
    with_text: bool = True,
) -> DataFrame:
    """One row per piece of each oversized text. Texts of few bytes are told apart in the scan; nothing is shuffled but a
    small input of a few files (``session.spread``)."""
    id_type = df.schema[id_col].dataType.simpleString()
    rows = spread(df.filter(F.octet_length(text_col) > max_tokens).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")))

    def run(batches):
        bpe = load_bpe(directory, name)
        for batch in small_batches(batches, "text"):
            ids, cols = batch.column("id"), [[] for _ in range(8)]
            for i, text in enumerate(batch.column("text").to_pylist()):
                for k, (a, b, s, e) in enumerate(split_text(bpe, text, max_tokens, overlap, min_tokens)):
                    for col, v in zip(cols, (i, k, a, b, s, e, e - s, text[a:b] if with_text else None)):
                        col.append(v)
            take = ids.take(pa.array(cols[0], pa.int64()))
            rest = [pa.array(c, pa.int64()) for c in cols[1:7]] + [pa.array(cols[7], pa.string())]
            yield pa.RecordBatch.from_arrays([take, *rest], ["id", "piece_no", "start_char", "end_char", "start_token", "end_token", "n_tokens", "text"])

    out = rows.mapInArrow(run, f"id {id_type}, piece_no long, start_char long, end_char long, start_token long, end_token long, n_tokens long, text string")
    return out.withColumnRenamed("id", id_col) if with_text else out.withColumnRenamed("id", id_col).drop("text")
