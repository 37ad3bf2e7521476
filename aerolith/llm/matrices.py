"""Sums of fixed-size count matrices over a whole table.

Each task adds up its own matrix and sends it in blocks of cells; blocks are summed by a shuffle on the
block, so no task or driver sees more than one matrix of the documented size per key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS = 1 << 14
BLOCKS = "key string, block int, cells binary"
FOLDS = 5


def held_out() -> Column:
    """The rows no model learns from: crc32 of the id as text leaves 0 modulo 5 (a null id counts as '')."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS == 0


def blocks(key: str, matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    flat = matrix.reshape(-1).astype("<i8")
    rows = [(n, flat[a : a + CELLS]) for n, a in enumerate(range(0, len(flat), CELLS))]
    rows = [(n, cells.tobytes()) for n, cells in rows if cells.any()]
    yield pa.RecordBatch.from_arrays(
        [pa.array([key] * len(rows), pa.string()), pa.array([n for n, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.binary())],
        ["key", "block", "cells"],
    )


def summed(parts: DataFrame) -> DataFrame:
    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, "<i8") for c in table.column("cells").to_pylist())
        return pa.table({"key": table.column("key")[:1], "block": table.column("block")[:1], "cells": pa.array([total.tobytes()], pa.binary())})

    return parts.groupBy("key", "block").applyInArrow(add, BLOCKS)


def gathered(parts: DataFrame, size: int) -> dict[str, np.ndarray]:
    """The summed matrices on the driver: ``size`` cells for each key."""
    found: dict[str, np.ndarray] = {}
    for row in summed(parts).toLocalIterator():
        cells = np.frombuffer(bytes(row.cells), "<i8")
        found.setdefault(row.key, np.zeros(size, np.int64))[row.block * CELLS : row.block * CELLS + len(cells)] = cells
    return found
