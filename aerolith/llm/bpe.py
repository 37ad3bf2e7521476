"""Token ids of whole texts by a public byte-level BPE vocabulary.

Byte-level BPE never merges across the pieces its pattern cuts, so a text's ids are the ids of its
pieces in order. Texts are cut at the vocabulary's special tokens, then into pieces with numpy, each distinct piece is encoded once by the
``tokenizers`` library and kept in a bounded cache of the worker.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

from aerolith.llm.arrays import ragged

VOCABULARY = "byte_bpe_50k.json"
CACHED_PIECES = 1_000_000
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)
# The contractions of the vocabulary's pattern.
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
_WHITE_SPACE = {*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}


@cache
def _classes() -> np.ndarray:
    """Class of every code point."""
    kinds = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
    for point in range(sys.maxunicode + 1):
        first = unicodedata.category(chr(point))[0]
        if first == "L":
            kinds[point] = _LETTER
        elif first == "N":
            kinds[point] = _NUMBER
    kinds[list(_WHITE_SPACE)] = _SPACE
    return kinds


def piece_starts(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where the pattern's pieces start in the code points of some rows; ``rows`` are row offsets."""
    n = len(points)
    kinds = _classes()[points]
    first = np.zeros(n + 1, bool)
    first[rows] = True
    change = np.ones(n, bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change |= first[:n]
    starts = change.copy()
    space = kinds == _SPACE
    # The last white space of a run before other text is cut off; a plain space goes to the piece that follows.
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:]
    last &= ~first[1:]
    at = np.flatnonzero(last)
    starts[at] = True
    joins = at[points[at] == 0x20]
    starts[joins + 1] = False
    # Contractions: an apostrophe that starts a piece takes the letters it is listed with.
    quotes = np.flatnonzero((points == 0x27) & starts)
    for q in quotes.tolist():
        stop = min(q + 3, n)
        after = "".join(map(chr, points[q:stop].tolist()))
        found = next((c for c in _CONTRACTIONS if after.startswith(c)), None)
        if found and not first[q + 1 : q + len(found)].any():
            starts[q + 1] = False
            end = q + len(found)
            if end < n and kinds[end] == _LETTER:
                starts[end] = True
    return np.flatnonzero(starts)


class Encoder:
    """Ids of pieces, with a cache of at most ``CACHED_PIECES`` besides those of one call."""

    def __init__(self, path: str):
        # One thread: Spark hands out the cores.
        os.environ["TOKENIZERS_PARALLELISM"], os.environ["RAYON_NUM_THREADS"] = "false", "1"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Texts of special tokens are ids of their own, whatever stands around them.
        added = self.tokenizer.get_added_tokens_decoder()
        self.special = {token.content: number for number, token in added.items()}
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("the vocabulary has special tokens that take in what stands beside them")
        longest = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        self.known: dict[bytes, int] = {}
        self.ids, self.offsets, self.used = np.zeros(1 << 16, np.int32), np.zeros(1 << 16, np.int64), 0

    def _learn(self, pieces: list[bytes]) -> None:
        for begin in range(0, len(pieces), 20_000):
            part = pieces[begin : begin + 20_000]
            lists = [e.ids for e in self.tokenizer.encode_batch_fast([p.decode() for p in part], add_special_tokens=False)]
            lengths = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((i for x in lists for i in x), np.int32, int(lengths.sum()))
            count = len(self.known)
            while count + len(part) + 1 > len(self.offsets):
                self.offsets = np.concatenate([self.offsets, np.zeros_like(self.offsets)])
            while self.used + len(flat) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : self.used + len(flat)] = flat
            self.offsets[count + 1 : count + len(part) + 1] = self.used + np.cumsum(lengths)
            self.used += len(flat)
            self.known.update(zip(part, range(count, count + len(part)), strict=True))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the offsets of each text's ids, as the library gives them by default."""
        joined = "".join(texts)
        if not any(special in joined for special in self.special):
            return self._plain(texts)
        parts = [self.cut.split(text) for text in texts]
        count = np.fromiter(map(len, parts), np.int64, len(parts))
        flat = [part for one in parts for part in one]
        own = np.fromiter((self.special.get(part, -1) for part in flat), np.int64, len(flat))
        ids, offsets = self._plain(["" if n >= 0 else part for part, n in zip(flat, own.tolist(), strict=True)])
        ends = np.cumsum(np.diff(offsets) + (own >= 0))
        out = np.empty(int(ends[-1]), np.int32)
        single = np.zeros(len(out), bool)
        single[ends[own >= 0] - 1] = True
        out[single], out[~single] = own[own >= 0], ids
        return out, np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > CACHED_PIECES:
            self.known.clear()
            self.used = 0
        joined = "".join(texts)
        rows = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        starts = piece_starts(points, rows)
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        ends = np.cumsum(width, dtype=np.int64)
        places = np.concatenate([ends[starts] - width[starts], ends[-1:]])
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(joined.encode())])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        known = self.known
        new = [p for p in distinct if p not in known]
        if new:
            self._learn(new)
        number = np.fromiter((known[p] for p in distinct), np.int64, len(distinct))[coded.indices.to_numpy(zero_copy_only=False)]
        begin = self.offsets[number]
        lengths = self.offsets[number + 1] - begin
        ids = self.ids[ragged(begin, lengths)]
        total = np.concatenate([[0], np.cumsum(lengths)])
        return ids, total[np.searchsorted(starts, rows)]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
