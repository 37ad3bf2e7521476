"""Words of text columns, rewritten with one space between them."""

from __future__ import annotations

import numpy as np

from aerolith.llm.arrays import ragged


def word_spans(content: np.ndarray, offsets: np.ndarray, splits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of the maximal runs of bytes that split nothing, and the word offsets of the rows."""
    inside = np.zeros(len(content) + 1, bool)
    inside[:-1] = ~splits[content]
    edge = inside.copy()
    edge[1:] ^= inside[:-1]
    # A row border inside a run of bytes ends one word and begins the next.
    borders = np.unique(offsets[1:-1])
    borders = borders[(borders > 0) & (borders < len(content))]
    borders = borders[inside[borders] & inside[borders - 1]]
    starts = np.sort(np.concatenate([np.flatnonzero(edge & inside), borders]))
    ends = np.sort(np.concatenate([np.flatnonzero(edge & ~inside), borders]))
    return starts, ends, np.searchsorted(starts, offsets)


def spaced(content: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words, each followed by one space, and where each begins (one more entry than words)."""
    lengths = ends - starts + 1
    begins = np.concatenate([[0], np.cumsum(lengths)])
    padded = np.concatenate([content, np.zeros(1, np.uint8)])
    packed = padded[ragged(starts, lengths)]
    packed[begins[1:] - 1] = 0x20
    return packed, begins
