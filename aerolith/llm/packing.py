"""Best-fit packing of token ids into fixed-length training sequences.

A document is the ids of its whole text and an end id (a null or empty text is the end id alone). Only a
document longer than a sequence is cut: into full sequences, and a first piece with what is left over.
Pieces are dealt into groups of about ``PIECES_PER_GROUP`` by a hash, so no group grows with the input,
and each group is packed on its own, longest piece first. A bin has three capacities: tokens, documents
and attention cost (the sum of squared piece lengths). Among the bins that satisfy all three, the one with
the smallest weighted norm of what is left after placing the piece takes it; else a new bin opens. Bins of
a group that end up less than ``FULL`` full are dissolved and packed once more with those of other groups.

Repeated rows and ties are separate pieces, ordered by id and place; an empty table has no pieces.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.arrays import list_array, sliced
from aerolith.llm.bpe import encoder, vocabulary_path
from aerolith.llm.tables import stored, texts

SEQUENCE = 2048
END_ID = 0
PIECES_PER_GROUP = 1 << 14
FULL = 0.98
WEIGHTS = (1.0, 0.01, 0.01)
PIECES = "row long, doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long"
PLACED = "row long, bin int, offset long, filled long"


def token_batches(
    batches: Iterator[pa.RecordBatch], vocabulary: str, end_id: int
) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """``doc_id`` column, flat ids with the end id after each document, and id offsets."""
    coder = encoder(vocabulary)
    for batch in batches:
        for part in sliced(batch, "text"):
            ids, offsets = coder.encode(part.column("text").to_pylist())
            count = np.diff(offsets)
            ends = offsets[1:] + np.arange(1, len(offsets))
            flat = np.full(len(ids) + len(count), end_id, np.int32)
            mask = np.ones(len(flat), bool)
            mask[ends - 1] = False
            flat[mask] = ids
            yield part.column("doc_id"), flat, np.concatenate([[0], ends])


def cut_pieces(docs: DataFrame, vocabulary: str | None = None, length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Token ids of every document in pieces of at most ``length``; ``row`` numbers the pieces."""
    path = vocabulary or vocabulary_path()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 36)
        for doc_ids, flat, offsets in token_batches(batches, path, end_id):
            total = np.diff(offsets)
            pieces = -(-total // length)
            doc = np.repeat(np.arange(len(total)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            head = total - (pieces - 1) * length
            start = np.where(piece == 0, 0, head[doc] + (piece - 1) * length)
            size = np.where(piece == 0, head[doc], length)
            begin = offsets[:-1][doc] + start
            raw = flat.astype("<u4")
            crc = [zlib.crc32(raw[a : a + n]) for a, n in zip(begin.tolist(), size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(number) for _ in doc], pa.int64()), doc_ids.take(pa.array(doc)), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(size, pa.int64()),
                    list_array(flat, np.concatenate([begin, [len(flat)]])), pa.array(crc, pa.int64()),
                ],
                ["row", "doc_id", "piece", "start", "length", "ids", "ids_crc32"],
            )

    return texts(docs).mapInArrow(cut, PIECES)


def best_fit(sizes: np.ndarray, tokens: int, documents: int, attention: int, weights=WEIGHTS) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, in the order given. Vector best fit by residual norm."""
    n = len(sizes)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    left = np.zeros((3, max(n, 1)))
    names = np.zeros(max(n, 1), np.int64)  # of the open bins
    caps = np.array([tokens, documents, attention], float)
    scale = np.sqrt(np.array(weights)) / caps
    opened = live = 0
    for i, size in enumerate(sizes.tolist()):
        need = (size, 1, size * size)
        if size > tokens or need[2] > attention:
            raise ValueError("a piece exceeds the capacity of an empty bin")
        chosen = -1
        if live:
            rest_tokens = left[0, :live] - size
            rest_cost = left[2, :live] - need[2]
            rest_docs = left[1, :live] - 1
            norm = (rest_tokens * scale[0]) ** 2
            norm += (rest_docs * scale[1]) ** 2
            norm += (rest_cost * scale[2]) ** 2
            norm[(rest_tokens < 0) | (rest_docs < 0) | (rest_cost < 0)] = np.inf
            best = int(norm.argmin())
            if norm[best] < np.inf:
                chosen = best
        if chosen < 0:
            chosen = live
            left[:, live] = caps
            names[live] = opened
            opened += 1
            live += 1
        bins[i] = names[chosen]
        offsets[i] = tokens - left[0, chosen]
        left[:, chosen] -= need
        if left[0, chosen] < 1 or left[1, chosen] < 1:  # closed: the last open bin takes its place
            live -= 1
            left[:, chosen] = left[:, live]
            names[chosen] = names[live]
    return bins, offsets


def pack(
    pieces: DataFrame, tokens: int = SEQUENCE, documents: int | None = None, attention: int | None = None, weights=WEIGHTS
) -> DataFrame:
    """``row, sequence_id, offset`` of every piece. The limits left out are those that tokens imply."""
    documents = documents or tokens
    attention = attention or tokens * tokens

    def place(table: pa.Table) -> pa.Table:
        frame = table.to_pandas().sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True])
        bins, offsets = best_fit(frame["length"].to_numpy(), tokens, documents, attention, weights)
        filled = np.bincount(bins, frame["length"].to_numpy(), minlength=1).astype(np.int64)
        return pa.table(
            {
                "row": pa.array(frame["row"].to_numpy()), "bin": pa.array(bins, pa.int32()),
                "offset": pa.array(offsets, pa.int64()), "filled": pa.array(filled[bins], pa.int64()),
            }
        )

    def packed(rows: DataFrame, tag: int) -> DataFrame:
        groups = max(1, -(-rows.count() // PIECES_PER_GROUP))
        dealt = rows.withColumn("_group", F.pmod(F.xxhash64("row"), F.lit(groups)))

        def place_group(key: tuple, table: pa.Table) -> pa.Table:
            done = place(table)
            sequence = (int(key[0].as_py()) << 24) + np.asarray(done.column("bin"), np.int64) * 2 + tag
            return done.set_column(1, "sequence_id", pa.array(sequence))

        return dealt.groupBy("_group").applyInArrow(place_group, "row long, sequence_id long, offset long, filled long")

    sizes = pieces.select("row", "doc_id", "piece", "length")
    first = stored(packed(sizes, 0), "packed")
    full = F.col("filled") >= FULL * tokens
    again = stored(sizes.join(first.where(~full), "row", "left_semi"), "repacked")
    return first.where(full).unionByName(packed(again, 1)).drop("filled")


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, tokens: int = SEQUENCE, documents: int | None = None, attention: int | None = None
) -> DataFrame:
    """Every piece with its ids and its place: ``sequence_id, offset``."""
    pieces = stored(cut_pieces(docs, vocabulary, tokens), "pieces")
    return pieces.join(pack(pieces, tokens, documents, attention), "row").drop("row")


def packing_digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return pack_documents(docs, vocabulary).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
