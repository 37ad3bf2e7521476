"""Text quality: random-indexing word vectors, pooled per document, and a two-layer network.

Words (runs of letters and digits, runs of other signs, line breaks, and a mark for each word's shape
and whether it repeats the word before) are hashed into ``WORDS`` rows. Every row has a fixed sparse random index vector; a word's vector is the sum of
the index vectors of its neighbours within ``REACH`` places, over all documents. A document is the mean of
its words' vectors. The network is fitted with numpy on at most ``MOST_LABELLED`` labelled documents (those
with the smallest hash of their id), and its probabilities are calibrated by a temperature fitted on a
part it was not trained on. Everything else covers every row and whole texts.

A null or empty text has the zero vector and gets a score all the same. Labels that are null are left
out; of repeated labels the mean decides. Without both label values the score is the share of label 1 (0.5
without labels). Source, language and id are never inputs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.llm.arrays import SPACES, hash_terms, mix, sliced, text_bytes
from aerolith.llm.matrices import BLOCKS, blocks, gathered, held_out

WORDS = 1 << 14
DIMENSIONS = 64
NONZERO = 2
REACH = 2
HIDDEN = 32
MOST_LABELLED = 20_000
THRESHOLD = 0.3
_SHAPES = 64
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_KIND = np.where(_WORD_BYTE, 1, np.where(SPACES, 0, 2)).astype(np.uint8)
_KIND[0x0A] = 3
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True


def word_rows(content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of each word, row of its shape mark, and the text it belongs to."""
    kind = _KIND[content]
    new = np.ones(len(kind), bool)
    new[1:] = kind[1:] != kind[:-1]
    new[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(content))
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(np.append(starts, len(content)).astype(np.int64)), pa.py_buffer(content)]
    ).dictionary_encode()
    hashed = (hash_terms(words.dictionary) % np.uint64(WORDS - _SHAPES)).astype(np.int64)
    rows = hashed[words.indices.to_numpy(zero_copy_only=False)] + _SHAPES
    upper = np.concatenate([[0], np.cumsum(_UPPER[content])])
    capitals = upper[ends] - upper[starts]
    length = ends - starts
    case = np.where(capitals == 0, 0, np.where((capitals == length) & (length > 1), 2, np.where(capitals == 1, 1, 3)))
    shape = kind[starts] * 16 + case * 4 + np.searchsorted([2, 5, 12], length)
    real = kind[starts] > 0
    text = (np.searchsorted(offsets, starts, side="right") - 1)[real]
    rows, shape = rows[real], shape[real]
    again = np.flatnonzero((rows[1:] == rows[:-1]) & (text[1:] == text[:-1])) + 1
    shape[again] %= 16  # a mark of its own for a word that repeats the one before
    return rows, shape, text


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Dimension and sign of each non-zero entry, by word row: fixed, so every task has the same."""
    bits = mix(np.arange(WORDS * NONZERO, dtype=np.uint64) + np.uint64(17)).reshape(WORDS, NONZERO)
    return (bits % np.uint64(DIMENSIONS)).astype(np.int64), (bits >> np.uint64(63)).astype(np.int64)


def _context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    dimension, sign = index_vectors()
    signed = dimension + DIMENSIONS * sign
    totals = np.zeros(WORDS * 2 * DIMENSIONS, np.int64)
    for batch in batches:
        for part in sliced(batch, "text", 1 << 19):
            rows, shape, text = word_rows(*text_bytes(part.column("text")))
            # Counted one list of keys after the other: a task holds one of them beside the totals.
            for step in range(1, REACH + 1):
                near = text[step:] == text[:-step]
                for here, there in ((rows[:-step], rows[step:]), (rows[step:], rows[:-step])):
                    for k in range(NONZERO):
                        np.add.at(totals, (here * (2 * DIMENSIONS) + signed[there, k])[near], 1)
            for k in range(NONZERO):  # the shape is a neighbour of its word, and the word of its shape
                np.add.at(totals, rows * (2 * DIMENSIONS) + signed[shape, k], 1)
                np.add.at(totals, shape * (2 * DIMENSIONS) + signed[rows, k], 1)
    cells = totals.reshape(WORDS, 2, DIMENSIONS)
    yield from blocks("context", cells[:, 0] - cells[:, 1])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all word rows: one fixed-size matrix, whatever the number of documents."""
    found = gathered(docs.select("text").mapInArrow(_context, BLOCKS), WORDS * DIMENSIONS)
    vectors = found.get("context", np.zeros(WORDS * DIMENSIONS, np.int64)).reshape(WORDS, DIMENSIONS).astype(np.float64)
    vectors = np.sign(vectors) * np.sqrt(np.abs(vectors))
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    used = np.abs(vectors).sum(axis=1) > 0
    if used.any():
        vectors[used] -= vectors[used].mean(axis=0)
    return vectors.astype(np.float32)


def pooled(vectors: np.ndarray, column: pa.Array) -> np.ndarray:
    """Mean vectors of the texts: those of their words, then those of their words' shapes."""
    means = np.zeros((len(column), 2 * DIMENSIONS), np.float32)
    rows, shape, text = word_rows(*text_bytes(column))
    counts = np.bincount(text, minlength=len(column))
    firsts = np.concatenate([[0], np.cumsum(counts)])
    for begin in range(0, len(column), 256):  # counts of words by text, times the vectors
        end = min(begin + 256, len(column))
        for half, named, size in ((0, rows, WORDS), (DIMENSIONS, shape, _SHAPES)):
            cells = np.empty((end - begin, size), np.float32)
            for low in range(begin, end, 32):  # the whole numbers of a few texts at a time
                high = min(low + 32, end)
                part = slice(firsts[low], firsts[high])
                counted = np.bincount((text[part] - low) * size + named[part], minlength=(high - low) * size)
                cells[low - begin : high - begin] = counted.reshape(-1, size)
            means[begin:end, half : half + DIMENSIONS] = cells @ vectors[:size]
    return means / np.maximum(counts, 1)[:, None].astype(np.float32)


@dataclass
class QualityModel:
    vectors: np.ndarray
    center: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    constant: float | None = None

    def score(self, column: pa.Array) -> np.ndarray:
        out = [np.zeros(0)]
        for part in sliced(pa.RecordBatch.from_arrays([column], ["text"]), "text", 1 << 20):
            out.append(self.probability(pooled(self.vectors, part.column("text"))))
        return np.concatenate(out)

    def probability(self, features: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(features), self.constant)
        return _sigmoid(_logit((features - self.center) / self.scale, self.layers)[0] / self.temperature)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _logit(x: np.ndarray, layers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    hidden = np.tanh(x @ layers[0] + layers[1])
    return hidden @ layers[2] + layers[3], hidden


def fit(vectors: np.ndarray, features: np.ndarray, labels: np.ndarray, seed: int = 7, steps: int = 1500) -> QualityModel:
    features, labels = np.asarray(features, float).reshape(-1, 2 * DIMENSIONS), np.asarray(labels, float)
    if len(set(labels.tolist())) < 2:
        share = float(labels.mean()) if len(labels) else 0.5
        return QualityModel(vectors, np.zeros(1), np.ones(1), [], 1.0, share)
    rng = np.random.default_rng(seed)
    center, scale = features.mean(axis=0), features.std(axis=0) + 1e-6
    x = (features - center) / scale
    part = rng.permutation(len(x))
    held, train = part[: max(len(x) // 5, 1)], part[max(len(x) // 5, 1) :]
    layers = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in layers], [np.zeros_like(w) for w in layers]
    for step in range(1, steps + 1):
        batch = rng.choice(train, min(256, len(train)), replace=False)
        logit, hidden = _logit(x[batch], layers)
        error = (_sigmoid(logit) - labels[batch]) / len(batch)
        back = np.outer(error, layers[2]) * (1 - hidden**2)
        gradients = [x[batch].T @ back + 1e-4 * layers[0], back.sum(axis=0), hidden.T @ error + 1e-4 * layers[2], error.sum(keepdims=True)]
        for n, gradient in enumerate(gradients):  # Adam
            first[n] = 0.9 * first[n] + 0.1 * gradient
            second[n] = 0.999 * second[n] + 0.001 * gradient**2
            layers[n] = layers[n] - 0.005 * (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
    logit = _logit(x[held], layers)[0]
    grid = np.geomspace(0.25, 8, 60)

    def loss(t: float) -> float:
        p = np.clip(_sigmoid(logit / t), 1e-9, 1 - 1e-9)
        return float(-(labels[held] * np.log(p) + (1 - labels[held]) * np.log(1 - p)).mean())

    return QualityModel(vectors, center, scale, layers, float(min(grid, key=loss)))


def train(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> QualityModel:
    """Word vectors from all of ``docs``; the network from labelled rows that are not held out."""
    vectors = word_vectors(docs)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text", 1 << 20):
                means = pooled(sent.value, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), pa.array([m.tobytes() for m in means], pa.binary())],
                    ["doc_id", "label", "features"],
                )

    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("quality"))
        .where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg((F.avg("quality") >= 0.5).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # At most ``most`` ids and labels: they go to the texts, so texts are neither shuffled nor pooled in vain.
    drawn = docs.sparkSession.createDataFrame(marked.collect(), marked.schema)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(drawn), "doc_id")
    pooled_rows = rows.mapInArrow(pool, "doc_id long, label int, features binary")
    # Rows that share an id count as documents of their own, within the same bound.
    sample = pooled_rows.orderBy(F.xxhash64("doc_id"), "doc_id", "features").limit(most).collect()
    sample.sort(key=lambda r: (r.doc_id, bytes(r.features)))
    features = np.array([np.frombuffer(bytes(r.features), np.float32) for r in sample]).reshape(len(sample), 2 * DIMENSIONS)
    return fit(vectors, features, np.array([r.label for r in sample]))


def scorer(docs: DataFrame, model: QualityModel):
    """A column function: text to the probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(sent.value.score(text))

    return score


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    score = scorer(docs, train(docs, labels))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.select("doc_id", held_out().alias("held_out"), score("text").alias("score")).withColumn("predicted", accepted().cast("int"))


def accepted(threshold: float = THRESHOLD) -> Column:
    return F.col("score") >= threshold


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    score = scorer(docs, train(docs, labels))
    rows = docs.select(F.struct("*").alias("_row"), score(docs["text"]).alias("_score"))
    return rows.where(F.col("_score") >= threshold).select("_row.*")
