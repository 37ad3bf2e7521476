"""Text columns as flat numpy arrays: bytes, words and their dictionary codes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes that split words: the space characters of the contracts, or everything that is no letter or digit.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NON_WORD = np.zeros(256, bool)
NON_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a string or binary column (null counts as empty) and the row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    content = np.frombuffer(data, np.uint8)[places[0] : places[-1]] if data and places[-1] > places[0] else np.zeros(0, np.uint8)
    return content, places - places[0]


@dataclass
class Words:
    """Words of some rows, in order: byte span of each word, words per row, dictionary codes."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray  # word offsets of the rows, one more than rows
    codes: np.ndarray
    terms: pa.Array  # the distinct words, as binary


def split_words(content: np.ndarray, offsets: np.ndarray, splits: np.ndarray, lower: bool = True) -> Words:
    """Maximal runs of bytes that are no split bytes; a word never crosses a row."""
    content = LOWER[content] if lower else content
    inside = ~splits[content]
    before = np.empty(len(inside), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    firsts = offsets[:-1][np.diff(offsets) > 0]
    before[firsts] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(inside), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    after[firsts[firsts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    lengths = np.concatenate([[0], np.cumsum(ends - starts)])
    packed = content[inside]
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(lengths.astype(np.int64)), pa.py_buffer(packed)]
    )
    coded = words.dictionary_encode()
    return Words(
        starts,
        ends,
        np.searchsorted(starts, offsets),
        coded.indices.to_numpy(zero_copy_only=False).astype(np.int64),
        coded.dictionary,
    )


_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    x += _MIX[0]
    x ^= x >> np.uint64(30)
    x *= _MIX[1]
    x ^= x >> np.uint64(27)
    x *= _MIX[2]
    x ^= x >> np.uint64(31)
    return x


def hash_terms(terms: pa.Array) -> np.ndarray:
    """A 64-bit hash of each distinct word, equal on every machine."""
    from xxhash import xxh3_64_intdigest

    return np.fromiter((xxh3_64_intdigest(t) for t in terms.to_pylist()), np.uint64, len(terms))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices ``start, start+1, ...`` of each run, one run after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def list_array(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), pa.array(flat)).cast(pa.list_(pa.from_numpy_dtype(flat.dtype)))


def sliced(batch: pa.RecordBatch, column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about ``most`` bytes of ``column``, so memory doesn't follow the batch size."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(lengths.astype(np.int64)) // most
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]
    for begin, end in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(begin, end - begin)
