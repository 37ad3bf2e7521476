"""Complete days of hourly rows (one row per station and time)."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 24


def complete_days(rows: DataFrame, slots: int = SLOTS, key: str = "station_id") -> DataFrame:
    """The first ``slots`` rows of each day that has that many, all with temperature and pm25.

    Adds ``slot``, the row's position in its day from 0.
    """
    day = Window.partitionBy(key, "date")
    whole = F.col("temperature").isNotNull() & F.col("pm25").isNotNull()
    first = rows.withColumn("slot", F.row_number().over(day.orderBy("timestamp"))).where(
        F.col("slot") <= slots
    )
    return (
        first.withColumn("_good", F.count_if(whole).over(day))
        .where(F.col("_good") == slots)
        .drop("_good")
        .withColumn("slot", F.col("slot") - 1)
    )


def _day_rank(key: str) -> Column:
    return F.dense_rank().over(Window.partitionBy(key).orderBy(F.desc("date")))


def _at(day: Column, slot: Column) -> Column:
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=slot)


def redate_recent(
    complete: DataFrame, anchor: str | date, days: int = 30, key: str = "station_id"
) -> DataFrame:
    """The last ``days`` complete days of each key, re-dated densely to end at ``anchor``."""
    day = F.date_sub(F.lit(str(anchor)).cast("date"), F.col("_rank") - 1)
    return (
        complete.withColumn("_rank", _day_rank(key))
        .where(F.col("_rank") <= days)
        .withColumns({"timestamp": _at(day, F.col("slot")), "date": F.date_format(day, "yyyy-MM-dd")})
        .drop("_rank")
    )


def profile_for_today(complete: DataFrame, as_of: datetime, key: str = "station_id") -> DataFrame:
    """Each key's latest complete day stamped on the day of ``as_of``, hours up to its hour."""
    today = F.lit(str(as_of.date())).cast("date")
    return (
        complete.withColumn("_rank", _day_rank(key))
        .where((F.col("_rank") == 1) & (F.col("slot") <= as_of.hour))
        .withColumns(
            {"timestamp": _at(today, F.col("slot")), "date": F.date_format(today, "yyyy-MM-dd")}
        )
        .drop("_rank")
    )
