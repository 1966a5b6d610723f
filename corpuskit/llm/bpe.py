"""Byte-level BPE of a public rank file, run inside Python workers.

``Bpe.encode`` gives exactly the ids of the rank file's own encoder. Texts whose characters all lie
in a checked set are split by a pattern of the standard ``re`` module and looked up piece by piece in
a bounded cache, which is several times faster; every other text goes to the encoder itself.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from functools import lru_cache

#: The pattern that splits text before the merges, and the default place of the files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
TOKENIZER_DIR = "/opt/tokenizers"
BYTE_BPE_50K = "byte_bpe_50k.tiktoken"

# Characters on which Python's \s, \d and \w agree with the white space, numbers and letters of PATTERN:
# ASCII without the separators 1C-1F, Latin-1 without superscripts and fractions, Latin Extended-A,
# Cyrillic, general punctuation, a few symbols, CJK ideographs and emoji.
_PLAIN = re.compile(
    "[\x00-\x1b\x20-\x84\x86-\xa0\xa1-\xb1\xb4\xb6-\xb8\xba\xbb\xbf-ſА-яЁё"
    "‐-‧‰-›​-‍﻿€™←-⇿　-。！（），：；？"
    "一-龥\U0001f300-\U0001f5ff\U0001f600-\U0001f64f\U0001f680-\U0001f6c5]*"
)
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_ASCII = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)
_ODD_ASCII = re.compile("[\x1c-\x1f]")
_CACHE_MAX = 200_000


class _Pieces(dict):
    """Ids of single pre-tokens, computed on first use; emptied when it holds too many."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, piece):
        ids = self._encode(piece)
        if len(self) >= _CACHE_MAX:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class _Counts(_Pieces):
    def __init__(self, pieces):
        super().__init__(lambda piece: len(pieces[piece]))


class Bpe:
    """Encoder over one rank file. A null text counts as an empty one: no ids."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, "rb") as lines:
            raw = lines.read()
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, raw.splitlines())}
        self.hash = hashlib.sha256(raw).hexdigest()[:16]
        self._all = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._pieces = _Pieces(self._all.encode_ordinary)
        self._counts = _Counts(self._pieces)

    @staticmethod
    def splitter(text: str):
        """The compiled fast pattern that splits ``text`` as PATTERN does, or None where none is sure to."""
        if text.isascii():
            return None if _ODD_ASCII.search(text) else _ASCII
        return _SPLIT if _PLAIN.fullmatch(text) else None

    def pieces(self, text: str) -> list[str]:
        """The pre-tokens of a text; together they are the text."""
        fast = self.splitter(text)
        if fast:
            return fast.findall(text)
        import regex

        return regex.findall(PATTERN, text)

    def encode(self, text: str | None) -> list[int]:
        if not text:
            return []
        fast = self.splitter(text)
        if fast is None:
            return self._all.encode_ordinary(text)
        of, out = self._pieces, []
        for piece in fast.findall(text):
            out += of[piece]
        return out

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        fast = self.splitter(text)
        if fast is None:
            return len(self._all.encode_ordinary(text))
        return sum(map(self._counts.__getitem__, fast.findall(text)))

    def piece_counts(self, pieces: list[str]) -> list[int]:
        """Tokens of each pre-token."""
        return list(map(self._counts.__getitem__, pieces))

    def decode(self, ids) -> bytes:
        """The raw bytes of ids; parts of an encoding may be decoded apart and their bytes joined."""
        return self._all.decode_bytes(list(ids))


@lru_cache(maxsize=4)
def load_bpe(directory: str = TOKENIZER_DIR, name: str = BYTE_BPE_50K) -> Bpe:
    """The encoder of a rank file, kept once per worker process."""
    return Bpe(os.path.join(directory, name))


def tokenizer_hash(directory: str = TOKENIZER_DIR, name: str = BYTE_BPE_50K) -> str:
    """A hash of the rank file alone, without building the encoder (driver side)."""
    with open(os.path.join(directory, name), "rb") as lines:
        return hashlib.sha256(lines.read()).hexdigest()[:16]
