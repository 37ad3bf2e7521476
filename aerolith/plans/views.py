"""The four serving views from readings and stations, and the daily batch job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from aerolith.operators import projections, rollups
from aerolith.operators.filters import rolling_window
from aerolith.operators.joins import enrich_left
from aerolith.operators.latest import latest_rows
from aerolith.session import delete_path, run_dir
from aerolith.sinks.tables import publish_view, write_enriched_lake
from aerolith.sources.lake import load_master
from aerolith.sources.registry import scan_stations
from aerolith.streaming.speed import hourly_rows, hourly_stream


def realtime_view(readings: DataFrame, stations: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Latest rated reading per known station.

    The newest reading is picked first; the station lookup and the labels then touch one row per
    station instead of every reading.
    """
    return rate_latest(latest_rows(readings, ["station_id"], "timestamp", tiebreak), stations)


def rate_latest(latest: DataFrame, stations: DataFrame) -> DataFrame:
    return projections.rate(latest.join(stations, "station_id"))


def hourly_view(
    readings: DataFrame, stations: DataFrame, how: str = "fixed", tz_offset_hours: int = 7
) -> DataFrame:
    """Hourly series of known stations, aggregated before the station lookup."""
    aqi = projections.rate(readings)
    windowed = hourly_stream(aqi, watermark=None, keys=("station_id",), how=how)
    return hourly_rows(windowed.join(stations, "station_id"), tz_offset_hours)


def daily_view(readings: DataFrame, stations: DataFrame, how: str = "fixed") -> DataFrame:
    """Daily rollup of all stations, aggregated before the station lookup."""
    return daily_from(rollups.daily_partials(readings, how=how), stations, how)


def daily_from(partials: DataFrame, stations: DataFrame, how: str = "fixed") -> DataFrame:
    return rollups.daily_from_partials(partials.join(stations, "station_id", "left"), how)


def summary_view(readings: DataFrame, stations: DataFrame, how: str = "fixed") -> DataFrame:
    partials = rollups.daily_partials(readings, ("station_id",), how)
    return summary_from(partials, stations, how)


def summary_from(partials: DataFrame, stations: DataFrame, how: str = "fixed") -> DataFrame:
    summary = rollups.summary_from_partials(partials, how)
    columns = rollups.SUMMARY_KEYS + tuple(c for c in summary.columns if c != "station_id")
    return summary.join(stations, "station_id", "left").select(*columns)


def run_daily_batch(
    spark: SparkSession,
    stations_path: str,
    output_root: str,
    as_of: str | date,
    history_path: str | None = None,
    lake_path: str | None = None,
    fallback_path: str | None = None,
    days: int = 30,
    window_history: bool = False,
) -> None:
    """Rebuild the enriched lake and the daily and summary views of the rolling window.

    Raw readings are read twice: once to write the enriched lake, once into additive daily state.
    The state is written out and serves both views. Any failure ends the job; a scheduler may
    run it again, every output is replaced as a whole.
    """
    start, end = rolling_window(as_of, days)
    stations = scan_stations(spark, stations_path).select("station_id", "province", "region")
    readings = load_master(
        spark, history_path, lake_path, fallback_path, start, end, window_history=window_history
    )
    enriched = projections.derive_conditions(enrich_left(readings, stations))
    write_enriched_lake(enriched, f"{output_root}/weather_historical.parquet")
    state_path = run_dir(spark, "daily-state")
    rollups.daily_partials(readings).write.parquet(state_path)
    state = spark.read.parquet(state_path)
    order = ("date", "region", "province", "station_id")
    publish_view(daily_from(state, stations).orderBy(*order), output_root, "daily")
    publish_view(summary_from(state, stations).orderBy(*order[1:]), output_root, "summary")
    delete_path(spark, state_path)
