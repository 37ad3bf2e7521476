"""Column reshaping between the feed, the views and the display."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.functions import rules

HISTORY_NAMES = {"time": "timestamp", "temp": "temperature", "rhum": "humidity"}
DISPLAY_NAMES = {"temperature": "temp", "pm25": "pm2_5", "aqi_index": "aqi_value"}
SERVING_ALIASES = {
    "temperature": "avg_temp",
    "humidity": "avg_humidity",
    "pm25": "avg_pm25",
    "no2": "avg_no2",
    "aqi_index": "avg_aqi",
}


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def to_double(df: DataFrame, *columns: str) -> DataFrame:
    """Cast to double; text that is not a number becomes null instead of failing the job."""
    return df.withColumns({c: F.col(c).try_cast("double") for c in columns})


def with_day(df: DataFrame) -> DataFrame:
    return df.withColumn("date", rules.day_string("timestamp"))


def with_hour(df: DataFrame, tz_offset_hours: int = 0) -> DataFrame:
    return df.withColumn("hour", F.expr(f"hour({rules.shift_hours_sql('timestamp', tz_offset_hours)})"))


def serving_aliases(hourly: DataFrame) -> DataFrame:
    return hourly.withColumns({name: F.col(source) for name, source in SERVING_ALIASES.items()})


def local_hours(windowed: DataFrame, tz_offset_hours: int = 7) -> DataFrame:
    """Window bounds as local ``timestamp`` and ``hour_end``; the window column goes."""
    return windowed.withColumns(
        {
            "timestamp": F.expr(rules.shift_hours_sql("window.start", tz_offset_hours)),
            "hour_end": F.expr(rules.shift_hours_sql("window.end", tz_offset_hours)),
        }
    ).drop("window")


def rate(readings: DataFrame, aqi_null: str = "zero", temp_null: str = "null") -> DataFrame:
    """Add the index and both alert labels to readings."""
    return readings.withColumn("aqi_index", rules.pm25_to_aqi("pm25", aqi_null)).withColumns(
        {
            "aqi_alert": rules.aqi_alert("aqi_index"),
            "temp_alert": rules.temp_alert("temperature", temp_null),
        }
    )


def derive_conditions(enriched: DataFrame) -> DataFrame:
    """Add the perceived temperature and the weather condition."""
    return enriched.withColumns(
        {
            "heat_index": rules.heat_index("temperature", "humidity"),
            "weather_condition": rules.weather_condition("pm25", "temperature"),
        }
    )


def display_shape(realtime: DataFrame) -> DataFrame:
    """Live rows as the all-provinces table shows them."""
    return realtime.select(
        "station_id",
        "province",
        "region",
        F.col("temperature").alias("temp"),
        "humidity",
        F.col("pm25").alias("pm2_5"),
        "no2",
        F.col("aqi_index").alias("aqi_value"),
        rules.aqi_category("aqi_index").alias("aqi_category"),
        "aqi_alert",
        "temp_alert",
        rules.is_anomaly("aqi_alert", "temp_alert").alias("is_anomaly"),
        "timestamp",
    )


def display_series(series: DataFrame) -> DataFrame:
    """Series or day-timeline rows as the charts read them."""
    kept = ("station_id", "time", "hour", "temp", "humidity", "pm2_5", "aqi_value")
    shown = rename(series, {"timestamp": "time", **DISPLAY_NAMES})
    return shown.select(*[c for c in kept if c in shown.columns])


def display_history(daily: DataFrame) -> DataFrame:
    """Daily rows as the history page reads them."""
    kept = ("station_id", "date", "avg_temp", "max_temp", "min_temp", "avg_aqi", "peak_aqi_hour")
    return daily.select(*[c for c in kept if c in daily.columns])


def stamp_ingestion(df: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Event time and day taken from one instant: now, or ``as_of``."""
    instant = F.lit(str(as_of)).cast("timestamp") if as_of else F.current_timestamp()
    return with_day(df.withColumn("timestamp", instant))
