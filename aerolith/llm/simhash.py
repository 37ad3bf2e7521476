"""Near duplicates by SimHash: fingerprints that differ in few bits, found by pigeonhole blocks.

A fingerprint has a bit for each bit of XXH64 (seed 42) of a document's word shingles, set if more than half of the
shingles, repeats included, have it set. With fewer words than ``words`` the whole sequence is one shingle; without
words the fingerprint is zero and links like any other.

Equal fingerprints are one class. The 64 bits are cut into ``near + 2`` blocks, so two fingerprints at distance
``near`` or less agree in two whole blocks: every class goes to one bucket for each pair of blocks, and buckets are
sorted, streamed and verified by Hamming distance in tasks. A bucket returns the edges of a spanning forest, not its
pairs. It is held in memory only up to ``MOST`` classes; members of a larger one go on to buckets that agree in two
more blocks, cut from the bits that are still free. Where that is not enough, hundreds of thousands of classes agree in
more than half of their bits; they meet in midpoints: two fingerprints at distance 4 or less both lie within distance 2
of some third, and all that lie within 2 of it are within 4 of each other. A midpoint has 2,081 neighbours at most,
whatever the input, and its smallest one is linked with the others. Nothing is capped: each way finds every component.

A null text is empty. A null id stands last and is returned as null; repeated rows are copies of each other. Columns
other than ``doc_id`` and ``text`` are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.arrays import LOWER, SPACES, ragged, sliced, text_bytes
from aerolith.llm.components import components
from aerolith.llm.joined import spaced, word_spans
from aerolith.llm.tables import id_key, id_value, stored, texts

SEED = 42
MOST = 1 << 16
SMALL = 16
CHUNK = 1 << 16
LANES = np.uint64(0x0101010101010101)
EDGES = "bucket int, a long, b long"
PARTS = "bucket int, part long, print long"


def shingle_hashes(column: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle, and the number of shingles of each row."""
    from xxhash import xxh64_intdigest

    content, offsets = text_bytes(column)
    starts, ends, rows = word_spans(content, offsets, SPACES)
    packed, begins = spaced(LOWER[content], starts, ends)
    raw = packed.tobytes()
    count = np.diff(rows)
    size = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
    first = ragged(rows[:-1], size)
    last = np.minimum(first + words, np.repeat(rows[1:], size))
    hashes = np.empty(len(first), np.uint64)
    for at in range(0, len(first), CHUNK):
        spans = zip(begins[first[at : at + CHUNK]].tolist(), (begins[last[at : at + CHUNK]] - 1).tolist(), strict=True)
        part = [xxh64_intdigest(raw[a:b], SEED) for a, b in spans]
        hashes[at : at + len(part)] = part
    return hashes, size


def majority(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """For each row the bits that more than half of its hashes have set."""
    pieces = -(-sizes // 255)  # eight counts share a word, so a piece has at most 255 hashes
    held = np.flatnonzero(sizes)
    prints = np.zeros(len(sizes), np.uint64)
    if not len(held):
        return prints
    row = np.repeat(np.arange(len(sizes)), pieces)
    nth = ragged(np.zeros(len(sizes), np.int64), pieces)
    begins = (np.cumsum(sizes) - sizes)[row] + 255 * nth
    counts = np.empty((len(begins), 8, 8), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & LANES, begins)
        counts[:, :, k] = lanes.view(np.uint8).reshape(-1, 8)
    firsts = (np.cumsum(pieces) - pieces)[held]
    total = np.add.reduceat(counts.reshape(-1, 64), firsts, axis=0)
    bits = np.packbits(2 * total > sizes[held][:, None], axis=1, bitorder="little")
    prints[held] = bits.view("<u8").reshape(-1)
    return prints


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id, print``: the fingerprint of every row, as a signed long."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                prints = majority(*shingle_hashes(part.column("text"), words))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(prints.view(np.int64))], ["doc_id", "print"])

    return texts(docs).select(id_key().alias("doc_id"), "text").mapInArrow(hashed, "doc_id long, print long")


def _cut(places: list[int], blocks: int) -> list[int]:
    """The bit places cut into blocks of like size, as masks."""
    return [sum(1 << int(p) for p in part) for part in np.array_split(np.array(places, int), blocks)]


class Buckets:
    """Masks of the buckets: pairs of blocks of all bits, then pairs of blocks of the bits that each leaves free."""

    def __init__(self, near: int):
        blocks = near + 2
        self.masks = [a | b for a, b in itertools.combinations(_cut(list(range(64)), blocks), 2)]
        self.wide = len(self.masks)
        for mask in self.masks[:]:
            free = [p for p in range(64) if not mask >> p & 1]
            self.masks += [mask | a | b for a, b in itertools.combinations(_cut(free, blocks), 2)]
        self.array = np.array(self.masks, np.uint64)

    def children(self, bucket: int) -> range:
        return range(self.wide) if bucket < 0 else range(self.wide * (bucket + 1), self.wide * (bucket + 2))

    def midpoints(self, bucket: int, near: int) -> np.ndarray:
        """Differences of up to half of ``near`` bits (rounded up) outside the bucket's mask."""
        free = [1 << p for p in range(64) if not self.masks[bucket] >> p & 1]
        flips = (c for n in range((near + 1) // 2 + 1) for c in itertools.combinations(free, n))
        return np.array([sum(c) for c in flips], np.uint64)


def _spread(rows: DataFrame, buckets: Buckets) -> DataFrame:
    """Each ``bucket, print`` in every bucket below its own."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            above = batch.column("bucket").to_numpy()
            prints = batch.column("print").to_numpy().view(np.uint64)
            for bucket in np.unique(above).tolist():
                mine = prints[above == bucket]
                for child in buckets.children(bucket):
                    part = mine & buckets.array[child]
                    arrays = [np.full(len(mine), child, np.int32), part.view(np.int64), mine.view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["bucket", "part", "print"])

    return rows.mapInArrow(spread, PARTS)


def forest(prints: np.ndarray, near: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what links within one bucket: a breadth-first search over those not yet reached."""
    rest, a, b = prints.copy(), [], []
    while len(rest) > 1:
        open_, rest = [rest[0]], rest[1:]
        while open_ and len(rest):
            one = open_.pop()
            close = np.bitwise_count(rest ^ one) <= near
            if close.any():
                found = rest[close]
                rest = rest[~close]
                a.append(np.full(len(found), one, np.uint64))
                b.append(found)
                open_.extend(found)
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.uint64), np.zeros(0, np.uint64))


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """Sorted rows as (bucket, part, print), cut so that all rows of a group are in one piece, or that the piece is
    within one group of more than ``most`` rows and the flag says so."""
    held: list[np.ndarray] = []
    size, streamed = 0, None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            if not batch.num_rows:
                continue
            new = np.stack([batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy(), batch.column(2).to_numpy()])
            held.append(new)
            size += new.shape[1]
        if not held:
            return
        last = held[-1][:2, -1]
        if batch is not None and (held[0][:2, 0] == last).all():
            if size > most:  # one group so far, too large to be held
                streamed = last.copy()
                yield *np.concatenate(held, axis=1), True
                held, size = [], 0
            continue
        rows = np.concatenate(held, axis=1)
        new_group = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
        if streamed is not None and (rows[:2, 0] == streamed).all():
            end = new_group[0] if len(new_group) else rows.shape[1]
            yield *rows[:, :end], True
            rows, new_group = rows[:, end:], new_group[1:] - end
        streamed = None
        cut = rows.shape[1] if batch is None else (new_group[-1] if len(new_group) else 0)
        if cut:
            yield *rows[:, :cut], False
        held, size = [rows[:, cut:]] if cut < rows.shape[1] else [], rows.shape[1] - cut


def _verify(batches: Iterator[pa.RecordBatch], buckets: Buckets, near: int, most: int) -> Iterator[pa.RecordBatch]:
    """Edges of each bucket; the members of one too large to be held come back with no second end."""

    def out(bucket: np.ndarray, a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
        ends = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(a.view(np.int64)), ends], ["bucket", "a", "b"])

    for bucket, part, signed, more in _groups(batches, most):
        prints = signed.copy().view(np.uint64)
        if more:
            yield out(bucket, prints, None)
            continue
        first = np.ones(len(bucket), bool)
        first[1:] = (bucket[1:] != bucket[:-1]) | (part[1:] != part[:-1])
        begins = np.flatnonzero(first)
        sizes = np.diff(np.append(begins, len(bucket)))
        ends = np.repeat(begins + sizes, sizes)
        small = np.repeat(sizes <= SMALL, sizes)
        for step in range(1, SMALL):  # small buckets of the piece all at once, by the distance of two rows in it
            at = np.flatnonzero(small[: len(bucket) - step] & (np.arange(step, len(bucket)) < ends[: len(bucket) - step]))
            if not len(at):
                break
            at = at[np.bitwise_count(prints[at] ^ prints[at + step]) <= near]
            yield out(bucket[at], prints[at], prints[at + step])
        for n in np.flatnonzero(sizes > SMALL).tolist():
            mine = slice(begins[n], begins[n] + sizes[n])
            if sizes[n] > most:
                yield out(bucket[mine], prints[mine], None)
            else:
                a, b = forest(prints[mine], near)
                yield out(np.full(len(a), bucket[begins[n]]), a, b)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by midpoint, each print with the first one of its midpoint."""
    last = first = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part, prints = batch.column("part").to_numpy(), batch.column("print").to_numpy()
        begins = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1])
        firsts = prints[begins].copy()
        if part[0] == last:
            firsts[0] = first
        a = np.repeat(firsts, np.diff(np.append(begins, len(part))))
        last, first = part[-1], a[-1]
        keep = a != prints
        yield pa.RecordBatch.from_arrays([pa.array(np.zeros(keep.sum(), np.int32)), pa.array(a[keep]), pa.array(prints[keep])], ["bucket", "a", "b"])


def _met(parts: DataFrame) -> DataFrame:
    """The parts dealt to as many partitions as shuffles have: buckets cost time by their pairs, not their bytes."""
    number = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return parts.repartition(number, "bucket", "part").sortWithinPartitions("bucket", "part", "print")


def links(prints: DataFrame, near: int = 4, most: int = MOST) -> DataFrame:
    """``a, b``: edges with the same components as all pairs of distinct ``print`` within ``near`` bits."""
    buckets = Buckets(near)
    open_, found = prints.select(F.lit(-1).alias("bucket"), "print"), []
    for level in range(2):
        met = _met(_spread(open_, buckets))
        result = stored(met.mapInArrow(lambda b: _verify(b, buckets, near, most), EDGES), f"links{level}")
        found.append(result.where("b IS NOT NULL"))
        open_ = result.where("b IS NULL").select("bucket", F.col("a").alias("print"))
        if open_.isEmpty():
            break
    else:

        def midpoints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                above = batch.column("bucket").to_numpy()
                signed = batch.column("print").to_numpy()
                for bucket in np.unique(above).tolist():
                    mine = signed[above == bucket].view(np.uint64)
                    flips = buckets.midpoints(bucket, near)
                    for at in range(0, len(mine), 256):
                        part = mine[at : at + 256]
                        mid = (part[:, None] ^ flips).reshape(-1)
                        arrays = [np.zeros(len(mid), np.int32), mid.view(np.int64), np.repeat(part, len(flips)).view(np.int64)]
                        yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["bucket", "part", "print"])

        found.append(stored(_met(open_.mapInArrow(midpoints, PARTS)).mapInArrow(_stars, EDGES), "stars"))
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    return edges.select("a", "b")


def near_components(docs: DataFrame, words: int = 4, near: int = 4, most: int = MOST) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id`` (the smallest id reachable by links)."""
    rows = stored(fingerprints(docs, words), "prints")
    classes = stored(rows.groupBy("print").agg(F.min("doc_id").alias("_least")), "classes")
    joined = components(links(classes, near, most)).select(F.col("node").alias("print"), F.col("root").alias("_root"))
    placed = classes.join(joined, "print", "left").withColumn("_root", F.coalesce("_root", "print"))
    least = placed.groupBy("_root").agg(F.min("_least").alias("_component"))
    known = placed.join(least, "_root").select("print", "_component")
    return rows.join(known, "print").select(
        id_value("doc_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        id_value("_component").alias("component_id"),
    )
