"""Readings at rest: history CSV, the date-partitioned lake, and the two combined."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.functions.rules import day_string
from aerolith.operators.filters import date_range
from aerolith.operators.projections import HISTORY_NAMES, rename
from aerolith.session import path_exists


def scan_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """Hourly history files with a header, as readings.

    Columns are found by name and cast one by one, so nothing is inferred from the data. All files
    of a path need one header; a file with another order or other columns is an error. Files
    without ``station_id``, ``pm25`` or ``no2`` give nulls there; ``time``, ``temp`` and ``rhum``
    are required.
    """
    raw = spark.read.csv(path, header=True, enforceSchema=False)
    missing = [c for c in HISTORY_NAMES if c not in raw.columns]
    if missing:
        raise ValueError(f"history file lacks {missing}")
    named = rename(raw, HISTORY_NAMES)
    typed = named.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in named.columns else F.lit(None).cast(f.dataType)).alias(
                f.name
            )
            for f in schemas.READING
            if f.name != "date"
        ]
    )
    return typed.select(
        day_string("timestamp").alias("date"), *[c for c in schemas.READING.names if c != "date"]
    )


def scan_lake(
    spark: SparkSession, path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Landed readings of the days ``start..end``; only those ``date=`` folders are read."""
    landed = spark.read.schema(schemas.READING).parquet(path)
    return date_range(landed, start, end).select(*schemas.READING.names)


def load_master(
    spark: SparkSession,
    history_path: str | None,
    lake_path: str | None,
    fallback_path: str | None = None,
    start: str | None = None,
    end: str | None = None,
    window_history: bool = False,
) -> DataFrame:
    """History united with the lake's ``start..end``, whichever of the two exist, else the fallback.

    The window applies to the lake alone unless ``window_history`` is set.
    """
    parts = []
    if history_path and path_exists(spark, history_path):
        history = scan_history_csv(spark, history_path)
        parts.append(date_range(history, start, end) if window_history else history)
    if lake_path and path_exists(spark, lake_path):
        parts.append(scan_lake(spark, lake_path, start, end))
    if not parts:
        if not (fallback_path and path_exists(spark, fallback_path)):
            raise FileNotFoundError("neither history, lake nor fallback data exists")
        parts.append(scan_history_csv(spark, fallback_path))
    master = parts[0]
    for part in parts[1:]:
        master = union_readings(master, part)
    return master


def union_readings(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union by column name; a column one side lacks is null there."""
    return left.unionByName(right, allowMissingColumns=True)
