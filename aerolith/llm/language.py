"""Language identification: multinomial naive Bayes over hashed character n-grams.

N-grams of one to three lower-cased code points (everything that is no letter counts as a space, and a
gram needs a letter) are hashed into ``CELLS`` cells. Counts per language cover every training row; each
task sends one vector per language it saw. The log-probability matrix (cells by languages) is broadcast, and documents are
scored in batches: the rows of the matrix that a document's grams name are summed per document. With more than
``LANGUAGES`` languages the matrix goes out in blocks of that many columns, each a pass over the documents, and a
document's best language and the sum of its likelihoods are combined over the passes.

A null text or one without a letter is ``und`` with score 0. Without any training row every document is ``und``.
Repeated rows count as often as they occur; of languages with equal scores the first by name is taken.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.arrays import sliced
from aerolith.llm.bpe import _LETTER, _classes
from aerolith.llm.matrices import BLOCKS, blocks, gathered, held_out
from aerolith.llm.tables import stored

BITS = 15
CELLS = 1 << BITS
GRAMS = (1, 2, 3)
LANGUAGES = 256
SMOOTHING = 0.5
UNKNOWN = "und"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def gram_cells(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each gram length: the cells of all grams and the text each belongs to."""
    lowered = [(t or "").lower() for t in texts]
    lengths = np.fromiter(map(len, lowered), np.int64, len(lowered))
    points = np.frombuffer("".join(lowered).encode("utf-32-le"), np.uint32)
    letter = _classes()[points] == _LETTER
    row = np.repeat(np.arange(len(lowered), dtype=np.int32), lengths)
    points = np.where(letter, points, 0x20).astype(np.uint64)
    value, some = np.zeros(len(points), np.uint64), np.zeros(len(points), bool)
    for n in GRAMS:
        shift = n - 1
        stop = max(len(points) - shift, 0)
        value = (value[:stop] << np.uint64(21)) | points[shift:]
        some = some[:stop] | letter[shift:]
        keep = np.flatnonzero(some & (row[:stop] == row[shift:]))
        tagged = value[keep] * np.uint64(8) + np.uint64(n)
        yield ((tagged * _ODD) >> np.uint64(64 - BITS)).astype(np.int64), row[keep]


@dataclass
class LanguageModel:
    languages: list[str]
    log_prior: np.ndarray
    log_cell: np.ndarray  # cells by languages

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The best language of each text and its probability."""
        names, best, rest, seen = self.totals(texts)
        return names, np.where(seen, np.exp(best - rest), 0.0)

    def totals(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """The best language of each text, its log score, the log sum of all scores, and whether a letter was seen."""
        total = np.zeros((len(texts), len(self.languages)))
        seen = np.zeros(len(texts), bool)
        for cells, row in gram_cells(texts):
            if not len(cells) or not self.languages:
                continue
            firsts = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            seen[row[firsts]] = True
            total[row[firsts]] += np.add.reduceat(self.log_cell[cells], firsts, axis=0, dtype=np.float64)
        if not seen.any():
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.zeros(len(texts)), seen
        total += self.log_prior
        best = total.argmax(axis=1)
        top = total.max(axis=1)
        rest = top + np.log(np.exp(total - top[:, None]).sum(axis=1))
        return [self.languages[b] if s else UNKNOWN for b, s in zip(best, seen, strict=True)], top, rest, seen


def train(rows: DataFrame, most: int = LANGUAGES) -> Iterator[LanguageModel]:
    """From the ``text`` and ``lang`` of all rows that have both: a model for each block of ``most`` languages by name."""
    rows = rows.select("text", F.col("lang").cast("string").alias("lang")).where("lang IS NOT NULL AND text IS NOT NULL")
    named = sorted(rows.groupBy("lang").count().collect(), key=lambda r: r.lang)
    if not named:
        yield LanguageModel([], np.zeros(0), np.zeros((CELLS, 0)))
    documents = sum(r["count"] for r in named)
    for at in range(0, len(named), most):
        part = named[at : at + most]
        names = [r.lang for r in part]
        mine = rows if len(named) <= most else rows.where(F.col("lang").between(names[0], names[-1]))
        prior = np.log(np.array([r["count"] for r in part], float) / documents)
        yield LanguageModel(names, prior, _log_cells(mine, names))


def _log_cells(rows: DataFrame, names: list[str]) -> np.ndarray:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in sliced(batch, "text", 1 << 20):
                languages = part.column("lang").to_pylist()
                known = sorted(set(languages))
                number = {name: n for n, name in enumerate(known)}
                language = np.array([number[x] for x in languages])
                counts = np.zeros(len(known) * CELLS, np.int64)
                for cells, row in gram_cells(part.column("text").to_pylist()):
                    counts += np.bincount(language[row] * CELLS + cells, minlength=len(counts))
                for name, cells in zip(known, counts.reshape(-1, CELLS), strict=True):
                    totals[name] = totals[name] + cells if name in totals else cells
        for name, cells in totals.items():
            yield from blocks(name, cells)

    found = gathered(rows.mapInArrow(count, BLOCKS), CELLS)
    counts = np.stack([found.get(name, np.zeros(CELLS, np.int64)) for name in names], axis=1) + SMOOTHING
    return np.log(counts / counts.sum(axis=0)).astype(np.float32)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", 1 << 20):
                languages, scores = sent.value.score(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(languages, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double")


def predict_in_blocks(docs: DataFrame, models: Iterable[LanguageModel]) -> DataFrame:
    """``predict`` by several models, each of other languages, in order of their names."""
    rows = stored(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text"), "numbered")
    parts = []
    for number, model in enumerate(models):
        sent = docs.sparkSession.sparkContext.broadcast(model)

        def score(batches: Iterator[pa.RecordBatch], number: int = number, sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in sliced(batch, "text", 1 << 20):
                    names, best, rest, seen = sent.value.totals(part.column("text").to_pylist())
                    columns = [part.column("row"), pa.array(best), pa.array(np.full(len(best), -number)), pa.array(names, pa.string()), pa.array(rest), pa.array(seen)]
                    yield pa.RecordBatch.from_arrays(columns, ["row", "best", "place", "name", "rest", "seen"])

        found = rows.select("row", "text").mapInArrow(score, "row long, best double, place long, name string, rest double, seen boolean")
        parts.append(stored(found, "scores"))
        sent.unpersist()
    scores = reduce(DataFrame.unionByName, parts)
    top = F.max("rest").alias("_top")
    known = scores.join(scores.groupBy("row").agg(top), "row").groupBy("row").agg(
        F.max(F.struct("best", "place", "name")).alias("_best"),
        F.sum(F.exp(F.col("rest") - F.col("_top"))).alias("_sum"),
        F.max("_top").alias("_top"),
        F.max("seen").alias("_seen"),
    )
    share = F.when(F.col("_seen"), F.exp(F.col("_best.best") - F.col("_top")) / F.col("_sum")).otherwise(F.lit(0.0))
    return rows.select("row", "doc_id").join(known, "row").select("doc_id", F.col("_best.name").alias("lang_pred"), share.alias("score"))


def identify(docs: DataFrame, most: int = LANGUAGES) -> DataFrame:
    """Learn from the rows that are not held out, then predict all rows."""
    rows = docs.select("doc_id", "text", "lang")
    models = train(rows.where(~held_out()), most)
    first, second = next(models), next(models, None)
    scored = predict(rows, first) if second is None else predict_in_blocks(rows, chain([first, second], models))
    return scored.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
