"""Views and history files built from hourly feeds instead of the live stream."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions.rules import day_string, hour_key
from aerolith.operators import complete, joins, latest, projections, rollups
from aerolith.session import run_dir
from aerolith.sinks.keyed import KeyedTable
from aerolith.sinks.tables import export_station_csv, publish_view
from aerolith.sources.messages import AIR_NAMES, WEATHER_NAMES, explode_hourly

DAYS = 30


def feed_rows(forecast: DataFrame, archive: DataFrame, air: DataFrame, payload: str = "payload") -> DataFrame:
    """Hourly rows of every station from columnar payloads (``station_id``, ``payload``)."""
    merged = joins.merge_feeds(
        explode_hourly(forecast, payload, WEATHER_NAMES, "_at"),
        explode_hourly(archive, payload, WEATHER_NAMES, "_at"),
        explode_hourly(air, payload, AIR_NAMES, "_at"),
        position="_at",
    )
    timed = merged.withColumn("timestamp", F.col("time").cast("timestamp_ntz")).drop("time")
    return timed.withColumn("date", day_string("timestamp"))


def recent_history(
    rows: DataFrame, stations: DataFrame, anchor: str | date, days: int = DAYS
) -> DataFrame:
    """Rated rows of the last complete days of known stations, re-dated to end at ``anchor``."""
    whole = complete.complete_days(rows.join(stations, "station_id"))
    return projections.rate(complete.redate_recent(whole, anchor, days), aqi_null="null")


def keep(history: DataFrame) -> DataFrame:
    """The history written to the shared folder, for the several views read from it."""
    path = run_dir(history.sparkSession, "history")
    history.write.parquet(path)
    return history.sparkSession.read.schema(history.schema).parquet(path)


def publish_batch_views(history: DataFrame, root: str) -> None:
    publish_view(rollups.complete_daily(history), root, "daily")
    publish_view(rollups.complete_summary(history), root, "summary")


def seed_views(history: DataFrame, root: str) -> None:
    """All four views from kept history."""
    publish_view(history.drop("slot"), root, "hourly")
    newest = latest.latest_per_key(history.drop("slot"), ["station_id"], ["timestamp"])
    publish_view(newest, root, "realtime")
    publish_batch_views(history, root)


def today_rows(rows: DataFrame, stations: DataFrame, as_of: datetime) -> DataFrame:
    """The latest complete day as today's hours so far, with their stable ids."""
    whole = complete.complete_days(rows.join(stations, "station_id"))
    rated = projections.rate(complete.profile_for_today(whole, as_of), aqi_null="null").drop("slot")
    return rated.withColumn("_id", hour_key("station_id", "timestamp"))


def fill_today(rows: DataFrame, stations: DataFrame, as_of: datetime, series: KeyedTable) -> None:
    """Put today's hours beside what the series already holds; columns the feeds lack keep their values."""
    today = today_rows(rows, stations, as_of)
    casts = {f.name: F.col(f.name).cast(f.dataType) for f in series.schema if f.name in today.columns}
    series.upsert(today.withColumns(casts), writer="fill")


def export_history(history: DataFrame, path: str) -> None:
    export_station_csv(history, path)
