"""From raw documents to packed training sequences: five stages, each a table that the next one reads.

Every stage works on all rows its predecessor kept. The first four return the rows they keep, with the
columns of ``documents``; the last returns the packed pieces. Null and empty texts, repeated rows and ties are
handled as each operator states.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm import decontaminate, exact_dedup, jaccard_join, packing, quality
from aerolith.llm.tables import stored, table

WORDS, LIMIT = 5, (80, 100)  # near duplicates: shingles of five words, similarity 0.8 or more


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original stays, then the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the smallest id stays."""
    return jaccard_join.keep_one(docs, WORDS, LIMIT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their place in a sequence."""
    return packing.packing_digest(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", drop_exact_duplicates),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# The classifier and the tokenizer are not SQL: the stages are tested against brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder before the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
