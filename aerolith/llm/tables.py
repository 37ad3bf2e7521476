"""Columns, intermediate tables and ids that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.session import run_dir

# A null id stands last and is written back as null; ids are compared in this form.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_key(name: str = "doc_id") -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def id_value(name: str) -> Column:
    return F.when(F.col(name) != NO_ID, F.col(name))


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` only, so other columns can't clash; a null text is empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.options(**({"compression": "zstd"} | options)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
