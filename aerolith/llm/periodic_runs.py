"""Periodic runs of words by minimizers at several scales.

A run is a maximal stretch of words with smallest period ``q`` (words ``q`` apart are equal) and at least ``2 q`` words.
All runs are found, without comparing all pairs of places:

* Periods under ``SHORT`` words are scanned directly: one comparison of the text with itself for each lag.
* For longer periods scales double: at scale ``P`` the periods from ``P`` to ``2 P - 1`` are found. Inside such a run
  the windows of ``P / 2`` words repeat at the distance of the period, and so do their minimizers, the grams of
  ``P / 4`` words with the smallest hash in a window. Pairs of equal minimizers at a distance of the scale seed an extension both ways.
* Grams with a period of a quarter of their length or less would be selected very often; they rank last and
  seed nothing. A run whose windows hold no other gram consists of parts of a run with a short period, found at a smaller
  scale, and contains the place right after that run's end: it is tried as a seed with every lag of the scale, which are fewer
  than the run has words. All other grams stand more than a quarter of their length apart, so a minimizer has
  at most 32 partners.

Both ways follow the number of words (times scales). Extensions compare hashes of 1, 2, 4, ... words; the
found stretch is compared word by word. Documents of a slice are scanned together, and a border between them equals nothing.

Words are ``[^\\x20\\x09-\\x0D]+``; a null or empty text has no words and no runs. Repeated rows are documents of their own; a
null id is returned as null, and its words are never replaced. Columns other than ``doc_id`` and ``text`` are
not read. An empty table gives an empty result. Memory follows the longest text of a slice: about 250 bytes per word.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from aerolith.llm.arrays import SPACES, hash_terms, mix, ragged, sliced, text_bytes
from aerolith.llm.joined import spaced, word_spans
from aerolith.llm.tables import texts

SHORT = 16  # a power of two: the first scale
LEVELS = 12  # extensions jump by 2^LEVELS words at most
RUNS = "doc_id long, start array<long>, length array<long>, period array<long>"
DIGEST = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


class Extension:
    """How far two places of a sequence agree, by hashes of 1, 2, 4, ... words."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.levels = [mix(codes.astype(np.uint64))]

    def grams(self, level: int) -> np.ndarray:
        """Hashes of the 2^level words from each place on (places near the end: up to the end)."""
        while len(self.levels) <= level:
            half = 1 << (len(self.levels) - 1)
            low = self.levels[-1]
            high = np.zeros_like(low)
            high[:-half] = low[half:] if half < len(low) else 0
            self.levels.append(mix(low * np.uint64(3) + high))
        return self.levels[level]

    def forward(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        """Number of equal words from ``a`` and ``b`` on; ``a < b``, and the last word equals no other."""
        gone = np.zeros(len(a), np.int64)
        active = np.arange(len(a))
        top = self.grams(level)
        while len(active):  # whole jumps of the longest gram
            x, y = a[active] + gone[active], b[active] + gone[active]
            fits = y + (1 << level) <= len(top)
            same = fits & (top[x] == top[np.where(fits, y, 0)])
            active = active[same]
            gone[active] += 1 << level
        for n in range(level - 1, -1, -1):
            grams, step = self.grams(n), 1 << n
            y = b + gone
            fits = y + step <= len(grams)
            gone += np.where(fits & (grams[a + gone] == grams[np.where(fits, y, 0)]), step, 0)
        return gone

    def backward(self, a: np.ndarray, b: np.ndarray, level: int) -> np.ndarray:
        """Number of equal words before ``a`` and ``b``."""
        gone = np.zeros(len(a), np.int64)
        active = np.arange(len(a))
        top, jump = self.grams(level), 1 << level
        while len(active):
            x, y = a[active] - gone[active] - jump, b[active] - gone[active] - jump
            same = (x >= 0) & (top[np.maximum(x, 0)] == top[np.maximum(y, 0)])
            active = active[same]
            gone[active] += jump
        for n in range(level - 1, -1, -1):
            grams, step = self.grams(n), 1 << n
            x, y = a - gone - step, b - gone - step
            gone += np.where((x >= 0) & (grams[np.maximum(x, 0)] == grams[np.maximum(y, 0)]), step, 0)
        return gone


def _stretches(same: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal runs of true values, of at least ``least``."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], same.view(np.int8), [0]])))
    starts, lengths = edge[::2], edge[1::2] - edge[::2]
    long = lengths >= least
    return starts[long], lengths[long]


def _minimizers(hashes: np.ndarray, last: np.ndarray, window: int) -> np.ndarray:
    """Places that hold the smallest (flag, hash) of some window of ``window`` places; the first of equal ones."""
    order = hashes >> np.uint64(1) | (last.astype(np.uint64) << np.uint64(63))
    best = np.arange(len(order))
    width = 1
    while width < window:  # the minimum of `width` places from each on, doubled or topped up
        step = min(width, window - width)
        left, right = best[:-step], best[step:]
        best = np.where(order[right] < order[left], right, left)
        width += step
    chosen = np.zeros(len(order), bool)
    chosen[best] = True
    return np.flatnonzero(chosen & ~last)


class Runs:
    """All maximal stretches (start, end, smallest period) of a sequence with at least two periods."""

    def __init__(self, codes: np.ndarray, longest: int):
        self.codes, self.extension = codes, Extension(codes)
        self.start = self.end = self.period = np.zeros(0, np.int64)
        top = min(LEVELS, max(longest, 1).bit_length())
        for lag in range(1, min(SHORT, longest // 2 + 1)):
            starts, lengths = _stretches(codes[lag:] == codes[:-lag], lag)
            self._add(starts, starts + lengths + lag, np.full(len(starts), lag))
        scale = SHORT
        while 2 * scale <= longest:
            self._scale(scale, top)
            scale *= 2

    def _add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        """New runs, in order of period; an extent known with a smaller period is the same run again."""
        if len(start):
            start, end, period = (np.concatenate([a, b]) for a, b in ((self.start, start), (self.end, end), (self.period, period)))
            order = np.lexsort((period, end, start))
            start, end, period = start[order], end[order], period[order]
            new = np.ones(len(start), bool)
            new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
            self.start, self.end, self.period = start[new], end[new], period[new]

    def _scale(self, scale: int, top: int) -> None:
        gram, level = scale // 4, (scale // 4).bit_length() - 1
        count = len(self.codes) - gram + 1
        if count <= 0:
            return
        hashes = self.extension.grams(level)[:count]
        short = self.period <= gram // 4
        inside = np.zeros(count + 1, np.int64)
        held = short & (self.end - self.start >= gram)
        np.add.at(inside, self.start[held], 1)
        np.subtract.at(inside, self.end[held] - gram + 1, 1)
        places = _minimizers(hashes, np.cumsum(inside[:-1]) > 0, gram + 1)
        order = np.lexsort((places, hashes[places]))
        places, value = places[order], hashes[places][order]
        a, b = [], []
        for step in range(1, len(places)):
            apart = np.where(value[step:] == value[:-step], places[step:] - places[:-step], 2 * scale)
            near = apart < 2 * scale
            if not near.any():
                break
            fit = np.flatnonzero(near & (apart >= scale))
            a.append(places[fit])
            b.append(places[fit + step])
        # The place after each run of a short period, with every lag of the scale.
        ends = self.end[short & (self.end - self.start >= scale)]
        ends = ends[ends < len(self.codes)]
        lags = np.arange(scale, 2 * scale)
        for at in range(0, len(ends), 4096):
            after = np.repeat(ends[at : at + 4096], scale)
            before = after - np.tile(lags, len(ends[at : at + 4096]))
            fit = (before >= 0) & (self.codes[np.maximum(before, 0)] == self.codes[after])
            a.append(before[fit])
            b.append(after[fit])
        if a:
            self._extend(np.concatenate(a), np.concatenate(b), top)

    def _extend(self, a: np.ndarray, b: np.ndarray, top: int) -> None:
        lag = b - a
        start = a - self.extension.backward(a, b, top)
        end = b + self.extension.forward(a, b, top)
        long = end - start >= 2 * lag
        found = np.unique(np.stack([start[long], end[long], lag[long]]), axis=1)
        exact = [bool((self.codes[s : e - p] == self.codes[s + p : e]).all()) for s, e, p in found.T.tolist()]
        if not all(exact):
            raise ArithmeticError("two different word sequences have the same hash")
        self._add(*found)


def planted(ids: list[int | None], rows: np.ndarray) -> np.ndarray:
    """For each word the word that stands in its place, by the ids' checksums: every tenth text gets a periodic end."""
    source = np.arange(rows[-1])
    for n, doc in enumerate(ids):
        first, count = int(rows[n]), int(rows[n + 1] - rows[n])
        if doc is None or not count:
            continue
        h = zlib.crc32(str(doc).encode())
        if h % 10 == 0:
            g = h // 10
            at = g % count
            period = 1 + (count - at) // (3 + g % 8)
            source[first + at : first + count] = first + at + np.arange(count - at) % period
    return source


def _slices(batches: Iterator[pa.RecordBatch], plant: bool) -> Iterator[tuple]:
    """For each slice: ids, packed words with their begins, word offsets of the rows, and (row, start, length, period)."""
    for batch in batches:
        for part in sliced(batch, "text"):
            ids = part.column("doc_id").to_pylist()
            content, offsets = text_bytes(part.column("text"))
            starts, ends, rows = word_spans(content, offsets, SPACES)
            if plant:
                source = planted(ids, rows)
                starts, ends = starts[source], ends[source]
            packed, begins = spaced(content, starts, ends)
            terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(packed)])
            coded = terms.dictionary_encode()
            known = np.concatenate([hash_terms(coded.dictionary), np.zeros(1, np.uint64)])[:-1]
            if len(np.unique(known)) < len(known):
                raise ArithmeticError("two different words have the same hash")
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            # A code of its own stands after every row.
            count = np.diff(rows)
            at = np.arange(len(codes)) + np.repeat(np.arange(len(ids)), count)
            line = np.empty(len(codes) + len(ids), np.int64)
            line[at] = codes
            borders = rows[1:] + np.arange(len(ids))
            line[borders] = len(known) + np.arange(len(ids))
            runs = Runs(line, int(count.max(initial=0)))
            row = np.searchsorted(borders, runs.start)
            first = rows[:-1] + np.arange(len(ids))
            yield ids, packed, begins, rows, (row, runs.start - first[row], runs.end - runs.start, runs.period)


def _reported(found: tuple[np.ndarray, ...], least: int) -> tuple[np.ndarray, ...]:
    """Runs of at least ``least`` words in order of row, start and period."""
    row, start, length, period = (a[found[2] >= least] for a in found)
    order = np.lexsort((period, start, row))
    return row[order], start[order], length[order], period[order]


def periodic_runs(docs: DataFrame, least: int = 12, plant: bool = False) -> DataFrame:
    """Every run of each document: ``doc_id`` and the arrays ``start, length, period``, by start, then period."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, _, _, found in _slices(batches, plant):
            row, *values = _reported(found, least)
            offsets = np.searchsorted(row, np.arange(len(ids) + 1))
            lists = [pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(v)).cast(pa.list_(pa.int64())) for v in values]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *lists], ["doc_id", "start", "length", "period"])

    return texts(docs).mapInArrow(find, RUNS)


def collapsed_digest(docs: DataFrame, least: int = 12, plant: bool = True) -> DataFrame:
    """One row per document: the number of runs, the longest one, and checksums of all runs and of the words left
    when each run keeps its first period only."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, packed, begins, rows, found in _slices(batches, plant):
            row, start, length, period = _reported(found, least)
            cuts = np.searchsorted(row, np.arange(len(ids) + 1)).tolist()
            dropped = np.zeros(rows[-1] + 1, np.int64)
            np.add.at(dropped, rows[:-1][row] + start + period, 1)
            np.subtract.at(dropped, rows[:-1][row] + start + length, 1)
            kept = np.flatnonzero(np.cumsum(dropped[:-1]) == 0)
            sizes = begins[kept + 1] - begins[kept]
            left = packed[ragged(begins[kept], sizes)].tobytes()
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.searchsorted(kept, rows)].tolist()
            out: list[tuple] = []
            for n, doc in enumerate(ids):
                mine = [v[cuts[n] : cuts[n + 1]] for v in (start, length, period)]
                printed = "".join(f"{s},{k},{p}\n" for s, k, p in zip(*(v.tolist() for v in mine), strict=True))
                best: tuple = (None, None, None, None)
                if printed:
                    top = int(np.argmax(mine[1]))  # the first of the longest: runs are in order of start and period
                    s, k, p = (int(v[top]) for v in mine)
                    best = (s, k, p, 1000 * k // p)
                words = left[ends[n] : max(ends[n + 1] - 1, ends[n])]
                out.append((doc, len(mine[0]), *best, hashlib.sha256(printed.encode()).hexdigest(), hashlib.sha256(words).hexdigest()))
            names = [f.split()[0] for f in DIGEST.split(", ")]
            types = [pa.int64()] * 6 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    return texts(docs).mapInArrow(digest, DIGEST)
