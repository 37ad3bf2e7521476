"""The operators as registered queries, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm import (
    centroids,
    decontaminate,
    exact_dedup,
    fuzzy_passages,
    jaccard_join,
    language,
    packing,
    periodic_runs,
    quality,
    simhash,
    suffix_dedup,
    token_store,
    transcripts,
)
from aerolith.llm.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_digest(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(table(spark, sf_dir, "documents"))


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), words=3, limit=(90, 100))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.chat_turns(table(spark, sf_dir, "conversations"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_digest(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fuzzy_passages.fuzzy_passages(table(spark, sf_dir, "documents"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.collapsed_digest(table(spark, sf_dir, "documents"))


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_components(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_exact_dedup,
        op3_token_store,
        op4_best_fit_packing,
        op5_jaccard_join,
        op6_chat_formatting,
        op7_suffix_array_dedup,
        op8_decontamination,
        op9_language_id,
        op10_fuzzy_passages,
        op11_periodic_runs,
        op12_centroid_clustering,
        op13_simhash_near_dedup,
    )
}
ORACLES = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op5_jaccard_join": jaccard_join.SQL,
    "op8_decontamination": decontaminate.SQL,
    "op12_centroid_clustering": centroids.SQL,
}
