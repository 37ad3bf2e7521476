"""Centroid clustering over a vector approximation file.

Components are whole numbers, ``floor(scale * x)``, and centroids exact floored means, so results are the same on every
cluster. Vectors are stored once beside their approximation: six bits per dimension, the number of the cell that the
component lies in. Cells hold about equal shares of each dimension; their bounds come from exact counts of all vectors.

In every round a table of 64 entries per dimension gives, by look-up and addition, a lower and an upper bound of the
distance to each centroid. What all distances of a vector have in common, its square, is left out, and places are taken
from the middle of the centroids: so the width of an interval follows the centroid's distance from the middle, not the
vector's. A centroid stays open if its lower bound does not exceed the smallest upper bound; the full vector is fetched
only where several are open. The sums of the clusters are carried along: a vector is fetched for them only if it changed its
centroid since the last round. The first round and the final distances need every vector. A round is one pass without a
shuffle but for one matrix of sums from each task.

Only vectors with exactly ``dims`` components, none null or non-finite, take part and are returned. ``floor(scale * x)``
beyond 2^26 either way counts as that bound, so that distances fit into a long; an inertia that doesn't is null. Null
ids stand after all others when the first centroids are chosen; repeated rows are vectors of their own; ties go to the
smaller components. With fewer vectors than centroids each vector is one. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.matrices import blocks, gathered
from aerolith.llm.tables import stored

LARGEST = 1 << 26
CELLS = 64  # cells of a dimension: six bits
FINE = 736  # bins of the counts on either side of zero
ROWS = 4096
STORED = "vec_id long, cells binary, vector binary"


def bin_of(values: np.ndarray) -> np.ndarray:
    """Bins that grow with the distance from zero, 32 to a power of two; monotone in the value."""
    size = np.where(values < 0, -values - 1, values)
    power = np.maximum(np.frexp(size.astype(np.float64))[1] - 1, 6).astype(np.int64)
    code = np.where(size < 64, size, 64 + (power - 6) * 32 + ((size >> (power - 5)) & 31))
    return np.where(values < 0, FINE - 1 - code, FINE + code)


def bin_starts() -> np.ndarray:
    """The smallest value of each bin, and the first value after the last bin."""
    edges = list(range(65))
    while len(edges) <= FINE:
        power = 6 + (len(edges) - 65) // 32
        edges.append(edges[-1] + (1 << (power - 5)))
    return np.array([-e for e in edges[:0:-1]] + edges, np.int64)


def cell_bounds(counts: np.ndarray) -> np.ndarray:
    """For each dimension the smallest value of every cell and, last, the first value after them all."""
    starts, bounds = bin_starts(), []
    for line in counts.reshape(-1, 2 * FINE):
        held = np.flatnonzero(line)
        cumulated = np.cumsum(line)
        cuts = np.searchsorted(cumulated, cumulated[-1] * np.arange(1, CELLS) / CELLS) + 1
        bounds.append(starts[np.concatenate([held[:1], np.minimum(cuts, held[-1] + 1), held[-1:] + 1])])
    return np.array(bounds)


def cells_of(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    cells = np.empty(values.shape, np.uint8)
    for d in range(values.shape[1]):
        cells[:, d] = np.searchsorted(bounds[d, 1:-1], values[:, d], side="right")
    return cells


def pack_cells(cells: np.ndarray) -> np.ndarray:
    """Four cells in three bytes."""
    padded = np.zeros((len(cells), -(-cells.shape[1] // 4) * 4), np.uint8)
    padded[:, : cells.shape[1]] = cells
    a, b, c, d = (padded[:, n::4] for n in range(4))
    return np.stack([a | b << 6, b >> 2 | c << 4, c >> 4 | d << 2], axis=2).reshape(len(cells), -1)


def unpack_cells(packed: np.ndarray, dims: int) -> np.ndarray:
    x, y, z = (packed[:, n::3] for n in range(3))
    cells = np.stack([x & 63, (x >> 6 | y << 2) & 63, (y >> 4 | z << 4) & 63, z >> 2], axis=2)
    return cells.reshape(len(packed), -1)[:, :dims]


def look_up_tables(bounds: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """(dimension, cell, 2 * centroids): what a cell adds to all lower, then all upper bounds."""
    middle = centroids.sum(axis=0) // len(centroids)
    low, high = (bounds[:, :-1] - middle[:, None])[:, None], (bounds[:, 1:] - 1 - middle[:, None])[:, None]
    at = (centroids - middle).T[:, :, None]
    ends = at * at - 2 * at * low, at * at - 2 * at * high  # linear in the component: its extremes are at the ends
    return np.concatenate([np.minimum(*ends), np.maximum(*ends)], axis=1).transpose(0, 2, 1)


def squared(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    out = np.empty((len(vectors), len(centroids)), np.int64)
    for n, c in enumerate(centroids):
        apart = vectors - c
        out[:, n] = np.einsum("ij,ij->i", apart, apart)
    return out


class Approximation:
    """Nearest centroids of a chunk of vectors by their cells; full vectors are taken only where bounds overlap."""

    def __init__(self, bounds: np.ndarray, centroids: np.ndarray):
        self.centroids, self.tables = centroids, look_up_tables(bounds, centroids)
        self.compared = 0

    def open(self, cells: np.ndarray) -> np.ndarray:
        total = self.tables[0][cells[:, 0]]
        for n in range(1, cells.shape[1]):
            total += self.tables[n][cells[:, n]]
        count = len(self.centroids)
        return total[:, :count] <= total[:, count:].min(axis=1)[:, None]

    def nearest(self, cells: np.ndarray, vectors: Vectors) -> np.ndarray:
        open_ = self.open(cells)
        cluster = open_.argmax(axis=1)
        several = np.flatnonzero(open_.sum(axis=1) > 1)
        if len(several):
            self.compared += len(several)
            full, among = vectors.fetch(several), open_[several]
            away = np.full(among.shape, np.iinfo(np.int64).max)
            for n in range(len(self.centroids)):
                mine = np.flatnonzero(among[:, n])
                away[mine, n] = squared(full[mine], self.centroids[n : n + 1])[:, 0]
            cluster[several] = away.argmin(axis=1)
        return cluster


def _rows(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of equally long values as rows of bytes, without a copy."""
    if not len(column):
        return np.zeros((0, width), np.uint8)
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32, 1, column.offset * 4)[0]
    return np.frombuffer(data, np.uint8, len(column) * width, first).reshape(-1, width)


class Vectors:
    """A binary column of vectors; rows are decoded when they are fetched."""

    def __init__(self, column: pa.Array, dims: int):
        self.rows = _rows(column, 4 * dims).view("<i4")

    def fetch(self, rows: np.ndarray) -> np.ndarray:
        return self.rows[rows].astype(np.int64)


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, Vectors]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            packed = _rows(part.column("cells"), -(-dims // 4) * 3)
            yield part, unpack_cells(packed, dims), Vectors(part.column("vector"), dims)


def _whole(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
    return np.clip(np.floor(values * scale), -LARGEST, LARGEST).astype(np.int64)


def _kept(embeddings: DataFrame, dims: int) -> DataFrame:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where((F.size("embedding") == dims) & finite)


def approximate(embeddings: DataFrame, dims: int = 64, scale: int = 64) -> tuple[DataFrame, np.ndarray | None]:
    """The stored table of approximations and vectors, with the bounds of the cells (None without vectors)."""
    kept = _kept(embeddings, dims)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, 2 * FINE), np.int64)
        for batch in batches:
            values = bin_of(_whole(batch.column("embedding"), dims, scale)) + np.arange(dims) * 2 * FINE
            total += np.bincount(values.reshape(-1), minlength=total.size).reshape(total.shape)
        yield from blocks("bins", total)

    counts = gathered(kept.select("embedding").mapInArrow(count, "key string, block int, cells binary"), dims * 2 * FINE)
    bounds = cell_bounds(counts["bins"]) if counts else None

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = _whole(batch.column("embedding"), dims, scale)
            columns = [_binary(pack_cells(cells_of(values, bounds))), _binary(values.astype("<i4"))]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), *columns], ["vec_id", "cells", "vector"])

    if bounds is None:
        return kept.select("vec_id", F.lit(b"").alias("cells"), F.lit(b"").alias("vector")).limit(0), None
    return stored(kept.mapInArrow(encode, STORED), "approximations"), bounds


def _binary(rows: np.ndarray) -> pa.Array:
    width = rows.shape[1] * rows.itemsize
    raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows))])
    return raw.cast(pa.binary())


def _first(table: DataFrame, k: int, seed: str) -> np.ndarray:
    """The vectors whose hashed ids are smallest: ``k`` rows."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = table.select(hashed.alias("_hash"), "vector").orderBy(F.col("_hash").asc_nulls_last(), "vector").limit(k).collect()
    return np.array([np.frombuffer(bytes(r.vector), "<i4") for r in rows]).astype(np.int64)


def _moves(table: DataFrame, dims: int, bounds: np.ndarray, old: np.ndarray | None, new: np.ndarray) -> np.ndarray:
    """By how much each cluster's sums and count change from the old centroids to the new ones."""

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        after = Approximation(bounds, new)
        before = None if old is None else Approximation(bounds, old)
        total = np.zeros((len(new), dims + 1), np.int64)
        for _, cells, vectors in _chunks(batches, dims):
            to = after.nearest(cells, vectors)
            origin = None if before is None else before.nearest(cells, vectors)
            moved = np.arange(len(to)) if origin is None else np.flatnonzero(to != origin)
            if len(moved):
                full = np.concatenate([vectors.fetch(moved), np.ones((len(moved), 1), np.int64)], axis=1)
                np.add.at(total, to[moved], full)
                if origin is not None:
                    np.subtract.at(total, origin[moved], full)
        yield from blocks("sums", total)

    found = gathered(table.select("cells", "vector").mapInArrow(change, "key string, block int, cells binary"), len(new) * (dims + 1))
    return found.get("sums", np.zeros(len(new) * (dims + 1), np.int64)).reshape(len(new), dims + 1)


def fit(table: DataFrame, bounds: np.ndarray, dims: int, k: int, rounds: int, seed: str) -> np.ndarray:
    """The centroids after all rounds: ``k`` rows of whole numbers."""
    centroids, old = _first(table, k, seed), None
    sums = np.zeros((len(centroids), dims + 1), np.int64)
    for _ in range(rounds):
        sums += _moves(table, dims, bounds, old, centroids)
        held = sums[:, -1:]
        old, centroids = centroids, np.where(held > 0, sums[:, :-1] // np.maximum(held, 1), centroids)
    return centroids


def cluster_vectors(
    embeddings: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: str = "1"
) -> DataFrame:
    """One row per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``."""
    spark = embeddings.sparkSession
    table, bounds = approximate(embeddings, dims, scale)
    if bounds is None:
        nothing = "cast(null as int) cluster, 0L distance, 0L cluster_inertia, 0L inertia, '' centroid_sha256"
        return table.selectExpr("vec_id", *nothing.split(", "))
    centroids = fit(table, bounds, dims, k, rounds, seed)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = Approximation(bounds, centroids)
        for part, cells, vectors in _chunks(batches, dims):
            cluster = last.nearest(cells, vectors)
            apart = vectors.fetch(np.arange(len(cluster))) - centroids[cluster]
            columns = [part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(np.einsum("ij,ij->i", apart, apart))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    assigned = stored(table.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("inertia")).collect()
    total = sum(r.inertia for r in sums)
    printed = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    # One row per centroid: k rows at most are broadcast.
    known = spark.createDataFrame([(r.cluster, r.inertia, total, printed[r.cluster]) for r in sums], "cluster int, a decimal(38,0), b decimal(38,0), sha string")
    return assigned.join(F.broadcast(known), "cluster").select(
        "vec_id", "cluster", "distance", F.expr("try_cast(a as long)").alias("cluster_inertia"),
        F.expr("try_cast(b as long)").alias("inertia"), F.col("sha").alias("centroid_sha256"),
    )


def _round_sql(n: int) -> str:
    """One round over ``c<n>`` (centroid, dimension, value): assignment ``a<n>``, then centroids ``c<n+1>``."""
    return f"""
), a{n} AS MATERIALIZED (
  SELECT row, arg_min(j, d * 1000 + j) AS j, min(d) AS d FROM (
    SELECT v.row, c.j, sum((v.x - c.x) * (v.x - c.x))::HUGEINT AS d FROM parts v JOIN c{n} c USING (i) GROUP BY v.row, c.j
  ) GROUP BY row
), c{n + 1} AS MATERIALIZED (
  SELECT c.j, c.i, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT j, i, (s - ((s % n) + n) % n) // n AS x FROM (
      SELECT a.j, v.i, sum(v.x)::HUGEINT AS s, count(*)::HUGEINT AS n FROM parts v JOIN a{n} a USING (row) GROUP BY ALL)
  ) m USING (j, i)"""


SQL = (
    """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), parts AS MATERIALIZED (
  SELECT row, i, floor(64 * embedding[i]::DOUBLE)::BIGINT AS x FROM kept, unnest(range(1, 65)) AS u(i)
), c0 AS MATERIALIZED (
  SELECT f.j, p.i, p.x::HUGEINT AS x FROM parts p JOIN (
    SELECT row, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS j FROM kept ORDER BY j LIMIT 16) f USING (row)"""
    + "".join(_round_sql(n) for n in range(4))
    + """
), printed AS (SELECT j, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS sha FROM c3 GROUP BY j)
SELECT vec_id, a3.j::INTEGER AS cluster, a3.d::BIGINT AS distance, (sum(a3.d) OVER (PARTITION BY a3.j))::BIGINT AS cluster_inertia,
  (sum(a3.d) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM a3 JOIN kept USING (row) JOIN printed USING (j)
"""
)
