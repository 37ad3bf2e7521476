"""Rolling views from additive state kept per day.

Sums, counts, extremes and the packed peak of each station and day are written once, partitioned by day. A daily run
reads the raw readings of the days that have no state yet, as a rule one, and builds the daily and summary views of
the rolling window from the states alone: a few numbers per station and day instead of all raw readings of 30 days.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators import projections, rollups
from aerolith.operators.filters import date_range, rolling_window
from aerolith.operators.joins import enrich_left
from aerolith.plans.views import daily_from, summary_from
from aerolith.session import folders, path_exists
from aerolith.sinks.tables import publish_view
from aerolith.sources.lake import scan_lake
from aerolith.sources.registry import scan_stations

_SUMS = ("temp", "humidity", "pm25", "no2")
STATE = T.StructType(
    [T.StructField("date", T.StringType()), T.StructField("station_id", T.StringType())]
    + [T.StructField(f"{kind}_{name}", T.LongType()) for name in _SUMS for kind in ("sum", "n")]
    + [T.StructField(name, T.DoubleType()) for name in ("max_temp", "min_temp")]
    + [T.StructField(name, T.LongType()) for name in ("sum_aqi", "n_aqi", "peak", "record_count")]
)


def days_between(start: str, end: str) -> list[str]:
    first, last = date.fromisoformat(start), date.fromisoformat(end)
    return [str(first + timedelta(days=n)) for n in range((last - first).days + 1)]


def known_days(spark: SparkSession, state_path: str) -> set[str]:
    """The days that have state; a day whose lake held no reading has an empty mark."""
    states = folders(spark, f"{state_path}/days/date=*")
    marks = folders(spark, f"{state_path}/seen/day=*")
    return {path.rsplit("=", 1)[1] for path in states + marks}


def _overwrite_days(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that ``df`` has rows of; a run that is repeated replaces what it wrote."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def update_state(spark: SparkSession, readings: DataFrame, state_path: str, days: Sequence[str]) -> None:
    """Write the state of ``days`` from their readings (a lake scan or any table with a ``date``)."""
    if not days:
        return
    wanted = date_range(readings, min(days), max(days)).where(F.col("date").isin(*days))
    state = rollups.daily_partials(wanted).select(*[F.col(f.name).cast(f.dataType) for f in STATE])
    _overwrite_days(state.repartition("date"), f"{state_path}/days", "date")
    marks = spark.createDataFrame([(day,) for day in days], "day string").withColumn("seen", F.lit(True))
    _overwrite_days(marks.coalesce(1), f"{state_path}/seen", "day")


def read_state(spark: SparkSession, state_path: str, start: str, end: str) -> DataFrame:
    """The states of the days ``start..end``; other days' folders are not opened."""
    if not path_exists(spark, f"{state_path}/days"):
        return spark.createDataFrame([], STATE)
    return date_range(spark.read.schema(STATE).parquet(f"{state_path}/days"), start, end)


def window_views(spark: SparkSession, state_path: str, stations: DataFrame, start: str, end: str) -> tuple[DataFrame, DataFrame]:
    """The daily and the summary view of a window of days, from their states."""
    state = read_state(spark, state_path, start, end)
    summed = state.drop("date", "sum_aqi", "n_aqi", "peak", "min_temp")
    return daily_from(state, stations), summary_from(summed, stations)


def run_daily_increment(
    spark: SparkSession,
    stations_path: str,
    lake_path: str,
    state_path: str,
    output_root: str,
    as_of: str | date,
    days: int = 30,
    again: Sequence[str] = (),
) -> list[str]:
    """The daily batch job over a lake, reading only days without state; returns the days it read.

    Days named in ``again`` are read anew, as when late readings were landed in them. The enriched lake gets the
    partitions of the same days. Every step replaces what an earlier, broken run may have left.
    """
    start, end = rolling_window(as_of, days)
    stations = scan_stations(spark, stations_path).select("station_id", "province", "region")
    known = known_days(spark, state_path)
    new = [day for day in days_between(start, end) if day not in known or day in again]
    if new:
        readings = scan_lake(spark, lake_path, min(new), max(new)).where(F.col("date").isin(*new))
        enriched = projections.derive_conditions(enrich_left(readings, stations))
        dealt = enriched.hint("rebalance", F.col("region"), F.col("date"))
        _overwrite_days(dealt, f"{output_root}/weather_historical.parquet", "region", "date")
        update_state(spark, readings, state_path, new)
    daily, summary = window_views(spark, state_path, stations, start, end)
    order = ("date", "region", "province", "station_id")
    publish_view(daily.orderBy(*order), output_root, "daily")
    publish_view(summary.orderBy(*order[1:]), output_root, "summary")
    return new
