"""Exact duplicates: 128-bit content hash first, bytes compared inside each hash group.

Texts are compared without the characters ``[\\x20\\x09-\\x0D]``; a null text is empty. Of equal texts the
row with the most code points in its original text stays, then the smallest ``doc_id`` (null ids stand
last). Of rows that repeat both id and text one is kept. An empty table gives an empty result.

One hash aggregation groups by (128-bit hash, normalised text): its key comparison compares the bytes,
so two texts that share a hash stay apart, and it combines copies before the shuffle, so a group with a
third of all rows arrives as one row per task. Only hashes and ids travel for the row that each document
gets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.tables import id_key, id_value, texts

SPACES = "[ \\t-\\r]+"
_WRAP = "cast('18446744073709551616' as decimal(38,0))"  # 2^64


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def content_hash(text: Column) -> Column:
    """128 bits of a text's content."""
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, hash_of=content_hash) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = texts(docs).select(
        id_key().alias("_id"),
        F.length("text").alias("_points"),
        normalised(F.col("text")).alias("_norm"),
    ).withColumn("_hash", hash_of(F.col("_norm")))
    # Most points first, then the smallest id, as one fixed-width number: no sort of texts.
    rank = F.expr(f"cast(cast(_points as decimal(10,0)) * {_WRAP} - cast(_id as decimal(20,0)) as decimal(38,0))")
    groups = (
        rows.select("_hash", "_norm", rank.alias("_rank"))
        .groupBy("_hash", "_norm")
        .agg(F.max("_rank").alias("_rank"), F.count(F.lit(1)).alias("group_size"))
        .select("_hash", F.sha2("_norm", 256).alias("text_sha256"), "group_size", _id_of("_rank").alias("_keep"))
    )
    members = (
        rows.select("_id", "_hash", F.sha2("_norm", 256).alias("text_sha256"), "_points")
        .groupBy("_id", "_hash", "text_sha256")
        .agg(F.count(F.lit(1)).alias("_copies"))
    )
    return (
        members.join(groups, ["_hash", "text_sha256"])
        .select("*", F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy"))
        .select(
            id_value("_id").alias("doc_id"),
            id_value("_keep").alias("keep_id"),
            F.col("group_size").cast("long").alias("group_size"),
            ((F.col("_id") == F.col("_keep")) & (F.col("_copy") == 1)).alias("kept"),
            "text_sha256",
        )
    )


def _id_of(rank: str) -> Column:
    """The id in a rank: rank = points * 2^64 - id, with ids from -2^63 to 2^63 - 1."""
    negated = f"pmod({rank}, {_WRAP})"  # (-id) modulo 2^64
    return F.expr(f"cast(if({negated} > 9223372036854775808BD, {_WRAP} - {negated}, -{negated}) as long)")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_groups(docs).where("kept").select(id_key().alias("_id"), F.col("text_sha256").alias("_sha"))
    keyed = docs.select(
        F.struct("*").alias("_row"), id_key().alias("_id"), F.sha2(normalised(F.col("text")), 256).alias("_sha"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).alias("_points"),
    )
    first = Window.partitionBy("_id", "_sha").orderBy(F.desc("_points"))
    return (
        keyed.join(kept, ["_id", "_sha"], "left_semi")
        .withColumn("_nth", F.row_number().over(first))
        .where("_nth = 1")
        .select("_row.*")
    )


SQL = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
  FROM documents
)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id)
"""
