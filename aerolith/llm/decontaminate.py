"""Benchmark decontamination by a distributed positional inverted index.

The documents are indexed in segments of about ``SEGMENT_WORDS`` words (a longer document is a segment of
its own): each segment stores, for every distinct word, the sorted list of its positions, as one row of a
table in the shared folder. Positions count through the segment and leave a gap between documents, so no
match crosses one. A query block holds windows of consecutive benchmark words. In each segment the
posting list of a window's rarest word proposes places, and the offset-adjusted lists of its other words,
from rare to frequent, are intersected with them; all windows go through one such step together.
With ``slop`` above 0 each other word may stand up to that many words from its place (proximity match).

Nothing is shuffled but one row per document. Benchmarks are cut into windows in tasks and stored in blocks of at most
``BLOCK_WORDS`` words (one item at least); each block is broadcast for a pass over the index, so what is broadcast is
bounded, and the driver hands on finished blocks one at a time.

Words: A-Z lower-cased, runs of bytes outside ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``. Null and empty texts have no
words. An item of fewer than ``window`` words, but not none, is one window. Rows that repeat are each
searched and returned; items with a null id count as the empty string.
"""

from __future__ import annotations

import itertools
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.arrays import NON_WORD, ragged, sliced, split_words, text_bytes
from aerolith.llm.tables import id_key, stored, texts

WINDOW = 10
SEGMENT_WORDS = 1 << 20
BLOCK_WORDS = 1 << 18
GAP = 64
SEGMENT = "segment long, doc_ids binary, first binary, n_words binary, terms binary, term_ends binary, list_ends binary, gaps binary"
HITS = "segment long, ordinal int, doc_id long, n_words long, items array<string>, spans array<struct<start:int,end:int>>"


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index: a row per segment."""
    rows = texts(docs).select(id_key().alias("doc_id"), "text")
    return stored(rows.mapInArrow(_index_partition, SEGMENT), "postings", **{"parquet.block.size": str(32 << 20)})


def _index_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = itertools.count(TaskContext.get().partitionId() << 32)
    held, size = [], 0
    for batch in batches:
        for piece in sliced(batch, "text"):
            content, offsets = text_bytes(piece.column("text"))
            words = split_words(content, offsets, NON_WORD)
            held.append((piece.column("doc_id").to_numpy(), np.diff(words.rows), words))
            size += len(words.codes)
            if size >= SEGMENT_WORDS:
                yield _segment(next(number), held)
                held, size = [], 0
    if held:
        yield _segment(next(number), held)


def _segment(number: int, parts: list) -> pa.RecordBatch:
    doc_ids = np.concatenate([p[0] for p in parts])
    n_words = np.concatenate([p[1] for p in parts])
    terms = pa.chunked_array([p[2].terms for p in parts]).combine_chunks().dictionary_encode()
    mapping = terms.indices.to_numpy(zero_copy_only=False)
    begins = np.cumsum([0, *(len(p[2].terms) for p in parts)])
    codes = np.concatenate([mapping[b + p[2].codes] for b, p in zip(begins[:-1], parts, strict=True)])
    first = np.concatenate([[0], np.cumsum(n_words[:-1] + GAP)])
    positions = ragged(first, n_words)
    order = np.argsort(codes, kind="stable")
    counts = np.bincount(codes, minlength=len(terms.dictionary))
    list_ends = np.cumsum(counts)
    places = positions[order]
    gaps = np.diff(places, prepend=0)
    heads = (list_ends - counts)[counts > 0]
    gaps[heads] = places[heads]
    content, term_offsets = text_bytes(terms.dictionary)
    blobs = (
        doc_ids.astype("<i8"), first.astype("<i8"), n_words.astype("<i4"), content,
        term_offsets[1:].astype("<i4"), list_ends.astype("<i4"), gaps.astype("<i4"),
    )
    names = ["segment", "doc_ids", "first", "n_words", "terms", "term_ends", "list_ends", "gaps"]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), *(pa.array([b.tobytes()], pa.binary()) for b in blobs)], names
    )


@dataclass
class QueryBlock:
    """Windows of benchmark words: rows of word numbers, -1 after a shorter item's end."""

    terms: list[bytes]
    windows: np.ndarray
    items: np.ndarray
    item_ids: list[str]


def query_blocks(items: DataFrame, window: int, most: int | None = None) -> Iterator[QueryBlock]:
    """The blocks, built in tasks and read one by one."""
    most = most or BLOCK_WORDS
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(row)
                size += len(row["text"]) // 2 + 1
                if size >= most:
                    yield _packed(held, window)
                    held, size = [], 0
        if held:
            yield _packed(held, window)

    # Few and short items are one block, not one for each of the table's partitions.
    dealt = rows.coalesce(max(1, -(-rows.agg(F.sum(F.length("text") + 1)).first()[0] // (2 * most)))) if not rows.isEmpty() else rows
    for row in stored(dealt.mapInArrow(build, "block binary"), "windows").toLocalIterator():
        yield pickle.loads(bytes(row.block))


def _packed(rows: list[dict], window: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([pickle.dumps(_query_block(rows, window))], pa.binary())], ["block"])


def _query_block(rows: list[dict], window: int) -> QueryBlock:
    words = split_words(*text_bytes(pa.array([r["text"] for r in rows], pa.large_string())), NON_WORD)
    counts = np.diff(words.rows)
    n_windows = np.where(counts > 0, np.maximum(counts - window + 1, 1), 0)
    item = np.repeat(np.arange(len(rows)), n_windows)
    begin = ragged(words.rows[:-1], n_windows)
    at = begin[:, None] + np.arange(window)
    inside = at < words.rows[1:][item][:, None]
    coded = words.codes if len(words.codes) else np.zeros(1, np.int64)
    windows = np.where(inside, coded[np.minimum(at, len(coded) - 1)], -1)
    return QueryBlock(words.terms.to_pylist(), windows, item, [r["item_id"] for r in rows])


class Segment:
    """The posting lists of one index row."""

    def __init__(self, row: dict):
        def ints(name: str, kind: str = "<i4") -> np.ndarray:
            return np.frombuffer(row[name], kind).astype(np.int64)

        self.doc_ids, self.first, self.n_words = ints("doc_ids", "<i8"), ints("first", "<i8"), ints("n_words")
        self.list_ends = ints("list_ends")
        self.counts = np.diff(self.list_ends, prepend=0)
        offsets = np.concatenate([[0], ints("term_ends")])
        self.terms = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(row["terms"])])
        term = np.repeat(np.arange(len(self.counts)), self.counts)
        running = np.cumsum(ints("gaps"))
        before = np.concatenate([[0], running])[self.list_ends - self.counts]
        self.places = running - before[term]
        # Lists stand one after the other, so (word, position) is sorted: one search serves all lists.
        self.keys = (term << 40) | self.places

    def matches(self, block: QueryBlock, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Window numbers and the positions at which they start."""
        import pyarrow.compute as pc

        found = pc.index_in(pa.array(block.terms, pa.large_binary()), value_set=self.terms)
        number = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        local = np.where(block.windows >= 0, number[block.windows] if len(number) else -1, -2)
        candidate = np.flatnonzero((local != -1).all(axis=1) & (local >= 0).any(axis=1))
        local = local[candidate]
        frequency = np.where(local >= 0, self.counts[np.maximum(local, 0)], np.iinfo(np.int64).max)
        order = np.argsort(frequency, axis=1, kind="stable")
        rarest, lane = order[:, 0], np.arange(len(local))
        term = local[lane, rarest]
        lengths = self.counts[term]
        window = np.repeat(lane, lengths)
        start = self.places[ragged(self.list_ends[term] - lengths, lengths)] - rarest[window]
        for nth in range(1, local.shape[1]):
            column = order[window, nth]
            wanted = local[window, column]
            low = start + column - slop
            at = np.searchsorted(self.keys, (np.maximum(wanted, 0) << 40) | np.maximum(low, 0))
            hit = self.keys[np.minimum(at, len(self.keys) - 1)] if len(self.keys) else np.zeros(len(at), np.int64)
            ok = (at < len(self.keys)) & (hit <= ((wanted << 40) | (start + column + slop))) & (low + slop >= 0)
            ok |= wanted < 0
            window, start = window[ok], start[ok]
        return candidate[window], start


def _search(batches: Iterator[pa.RecordBatch], block: QueryBlock, slop: int, every: bool) -> Iterator[pa.RecordBatch]:
    width = (block.windows >= 0).sum(axis=1)
    names = np.array(block.item_ids, object)
    for batch in batches:
        for row in batch.to_pylist():
            segment = Segment(row)
            window, start = segment.matches(block, slop)
            doc = np.searchsorted(segment.first, start, side="right") - 1
            doc = np.maximum(doc, 0)
            begin = np.maximum(start - segment.first[doc], 0)
            end = np.minimum(start - segment.first[doc] + width[window], segment.n_words[doc])
            order = np.lexsort((end, begin, doc))
            doc, begin, end, window = doc[order], begin[order], end[order], window[order]
            docs = np.arange(len(segment.doc_ids)) if every else np.unique(doc)
            low, high = np.searchsorted(doc, docs), np.searchsorted(doc, docs, side="right")
            items, spans = [], []
            for a, b in zip(low.tolist(), high.tolist(), strict=True):
                items.append(sorted(set(names[block.items[window[a:b]]])) if b > a else [])
                spans.append(_merged(begin[a:b], end[a:b]) if b > a else [])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(docs), row["segment"])), pa.array(docs, pa.int32()),
                    pa.array(segment.doc_ids[docs]), pa.array(segment.n_words[docs]),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ],
                ["segment", "ordinal", "doc_id", "n_words", "items", "spans"],
            )


def _merged(begin: np.ndarray, end: np.ndarray) -> list[dict]:
    """Maximal spans of sorted, overlapping ones."""
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(np.concatenate([[True], begin[1:] > reach[:-1]]))
    last = np.concatenate([new[1:] - 1, [len(begin) - 1]])
    return [{"start": int(s), "end": int(e)} for s, e in zip(begin[new], reach[last], strict=True)]


def find_matches(docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """One row per document: ``doc_id, n_words, items, spans`` (word spans covered by matches)."""
    if not 1 <= window <= GAP // 2 or not 0 <= slop < GAP // 2:
        raise ValueError(f"window must be 1 to {GAP // 2}, slop below {GAP // 2}")
    index = build_index(docs)
    passes = [_pass(index, QueryBlock([], np.zeros((0, window), np.int64), np.zeros(0, np.int64), []), slop, True)]
    for n, block in enumerate(query_blocks(items, window)):
        found = _pass(index, block, slop, n == 0)
        passes = [found] if n == 0 else [*passes, stored(found, "matches")]
    hits = passes[0]
    for more in passes[1:]:
        hits = hits.unionByName(more)
    merged = hits.groupBy("segment", "ordinal").agg(
        F.min("doc_id").alias("_id"),
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("_spans"),
    )
    spans = F.aggregate(
        "_spans",
        F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda done, span: F.when(
            (F.size(done) > 0) & (F.element_at(done, -1)["end"] >= span["start"]),
            F.concat(
                F.slice(done, 1, F.size(done) - 1),
                F.array(
                    F.struct(
                        F.element_at(done, -1)["start"].alias("start"),
                        F.greatest(F.element_at(done, -1)["end"], span["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(span))),
    )
    from aerolith.llm.tables import id_value

    return merged.select(id_value("_id").alias("doc_id"), "n_words", "items", spans.alias("spans"))


def _pass(index: DataFrame, block: QueryBlock, slop: int, every: bool) -> DataFrame:
    sent = index.sparkSession.sparkContext.broadcast(block)
    return index.mapInArrow(lambda batches: _search(batches, sent.value, slop, every), HITS)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` of every document."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]).cast("long"))
    return find_matches(docs, items, window).select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that hold no window of ``items``, with all their columns.

    Rows are told apart by a 64-bit hash of id and text, so rows that share an id, or have none, are judged by their own text.
    """
    mark = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")))
    bad = contamination(docs.select(mark.alias("doc_id"), "text"), items, window).where("contaminated").select(F.col("doc_id").alias("_mark"))
    return docs.select(F.struct("*").alias("_row"), mark.alias("_mark")).join(bad.distinct(), "_mark", "left_anti").select("_row.*")


SQL = r"""
WITH words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), items AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), windows AS (
  SELECT item_id, least(len(w), 10) AS n, list_slice(w, i, i + 9) AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows
), places AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS win
  FROM words, lengths, unnest(range(1, len(w) - n + 2)) AS u(i)
), hits AS (
  SELECT doc_id, i, p.n, item_id FROM places p JOIN windows USING (n, win)
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM hits, unnest(range(i, i + n)) AS u(j) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, cast(coalesce(len(w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
