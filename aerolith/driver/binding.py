"""Readings, stations and views derived from the driver's tables."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith import schemas
from aerolith.functions.rules import day_string
from aerolith.operators import projections, rollups
from aerolith.operators.filters import date_range
from aerolith.operators.joins import enrich_left
from aerolith.operators.latest import latest_rows
from aerolith.plans import views
from aerolith.plans.serving import Serving
from aerolith.session import run_dir
from aerolith.streaming.speed import state_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The mean that the jobs use: whole millionths, so both engines agree to the last digit.
HOW = "fixed"
TIEBREAK = ("event_id",)
AS_OF = "2024-01-31"
MID_MONTH = "2024-01-16"

# Declared columns of the tables used most, so no job runs to find them.
_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(binding)`` under ``name`` with its oracle."""

    def add(fn: Callable[[Binding], DataFrame]) -> Callable:
        QUERIES[name] = lambda spark, sf_dir: fn(Binding(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return fn

    return add


class Binding:
    def __init__(self, spark: SparkSession, sf_dir: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in _COLUMNS:
            reader = reader.schema(_COLUMNS[name])
        return reader.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, label: str) -> str:
        return run_dir(self.spark, label)

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def readings(self) -> DataFrame:
        """Events as readings, keeping the event's id and type."""
        return readings_of(self.events)

    @cached_property
    def strange(self) -> DataFrame:
        return with_strange_stations(self.readings)

    @cached_property
    def days(self) -> DataFrame:
        """Readings with the day as a date: cheaper to group on, a string again in every view."""
        return self.readings.withColumn("date", F.col("timestamp").cast("date"))

    @cached_property
    def stations(self) -> DataFrame:
        return self.registry.select("station_id", "province", "region")

    @cached_property
    def registry(self) -> DataFrame:
        named = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("customer")
            .join(named, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                station_of("c_custkey").alias("station_id"),
                F.col("c_custkey").alias("city_id"),
                F.col("n_name").alias("province"),
                F.col("r_name").alias("region"),
            )
        )

    @cached_property
    def enriched(self) -> DataFrame:
        return enrich_left(self.readings, self.stations)

    @cached_property
    def rated(self) -> DataFrame:
        return projections.rate(self.readings.join(self.stations, "station_id"))

    @cached_property
    def realtime(self) -> DataFrame:
        """Newest event of each station, decoded only once it is known to be the newest."""
        newest = latest_rows(
            self.events.drop("event_type"), ["user_id"], "ts", TIEBREAK
        ).withColumn("event_type", F.lit(None).cast("string"))
        rated = views.rate_latest(readings_of(newest), self.stations)
        return rated.select("event_id", *schemas.REALTIME_VIEW.names)

    @cached_property
    def hourly(self) -> DataFrame:
        return views.hourly_view(self.readings, self.stations, HOW)

    @cached_property
    def daily(self) -> DataFrame:
        return views.daily_view(self.days, self.stations, HOW)

    def daily_between(self, start: str, end: str) -> DataFrame:
        """The daily view of a range of days, whose bounds reach the scan."""
        return views.daily_view(date_range(self.days, start, end, "timestamp"), self.stations, HOW)

    @cached_property
    def summary(self) -> DataFrame:
        return views.summary_view(self.readings, self.stations, HOW)

    @cached_property
    def labelled(self) -> DataFrame:
        """Rated readings of all stations, known or not: no join."""
        return projections.rate(self.readings)

    @cached_property
    def windows(self) -> DataFrame:
        """Hourly statistics of known stations, aggregated before the station lookup."""
        hourly = rollups.hourly_rollup(self.labelled, keys=("station_id",), how=HOW)
        return hourly.join(self.stations, "station_id")

    @cached_property
    def station_hours(self) -> DataFrame:
        """Hourly means per station."""
        return self._means(self._hour_state, "station_id")

    @cached_property
    def region_hours(self) -> DataFrame:
        """Hourly means per region; regions stand in for stations where whole days are needed.

        Station-hours are summed first, so the join and the hot regions see few rows.
        """
        rows = self._means(self._hour_state.join(self.stations, "station_id"), "region")
        return rows.withColumns({"station_id": F.col("region"), "province": F.col("region")})

    @cached_property
    def _hour_state(self) -> DataFrame:
        hours = self.readings.withColumn("hour_start", F.window("timestamp", "1 hour")["start"])
        return rollups.daily_partials(hours, ("station_id", "hour_start"), HOW)

    def _means(self, state: DataFrame, key: str) -> DataFrame:
        means = rollups.summary_from_partials(state, HOW, (key, "hour_start"))
        return projections.with_day(
            means.select(
                key,
                F.col("hour_start").alias("timestamp"),
                F.col("avg_pm25").alias("pm25"),
                F.col("avg_temp").alias("temperature"),
                F.col("avg_humidity").alias("humidity"),
                F.col("avg_no2").alias("no2"),
            )
        )

    def serving(self, *needed: str) -> Serving:
        """Serving over the views named; the others are not built."""
        rows = {name if name == "registry" else f"{name}_rows": getattr(self, name) for name in needed}
        return Serving(**rows, snapshot=True)

    # Streams

    @cached_property
    def event_stream(self) -> DataFrame:
        # As a glob the path may be one file or a folder of files; a file source takes no bare file.
        return self.stream_of(f"{self.sf_dir}/events.parque[t]")

    def stream_of(self, path: str, strange: bool = False) -> DataFrame:
        """Events files as a stream of readings with instants, as a watermark needs."""
        raw = self.spark.readStream.schema(self.events.schema).parquet(path)
        readings = with_strange_stations(readings_of(raw)) if strange else readings_of(raw)
        return readings.withColumn("timestamp", F.col("timestamp").cast("timestamp"))

    def stateful(self) -> AbstractContextManager[None]:
        """State settings sized to the cluster's cores, for a stream that runs inside."""
        cores = max(8, self.spark.sparkContext.defaultParallelism)
        shuffle = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return state_settings(self.spark, min(shuffle, cores))


def station_of(key: str) -> Column:
    return F.concat(F.lit("U"), F.col(key).cast("string"))


def readings_of(events: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return events.select(
        "event_id",
        "event_type",
        station_of("user_id").alias("station_id"),
        F.col("ts").alias("timestamp"),
        day_string("ts").alias("date"),
        F.col("value").alias("pm25"),
        (k.cast("int") * F.lit(0.5) - F.lit(5.0)).alias("temperature"),
        k.cast("double").alias("humidity"),
        ((F.col("event_id") % 100) * F.lit(0.5)).alias("no2"),
    )


def with_strange_stations(readings: DataFrame) -> DataFrame:
    """Readings in which errors name unknown stations and clicks name none."""
    kind = F.col("event_type")
    unknown = F.when(kind == "error", F.concat(F.lit("X"), "station_id")).when(kind != "click", F.col("station_id"))
    return readings.withColumn("station_id", unknown)


def without_zone(df: DataFrame) -> DataFrame:
    """Timestamps as the driver's tables have them."""
    zoned = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df
