"""Row filters shared by pipelines and serving queries."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEVERITIES = ("aqi", "temp", "all")
_ALERT_TYPE_OF = {"aqi": "Air Quality", "temp": "Temperature"}


def _as_date(day: str | date) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def rolling_window(as_of: str | date, days: int = 30) -> tuple[str, str]:
    """Inclusive (start, end) of the ``days`` whole days before ``as_of``."""
    today = _as_date(as_of)
    return str(today - timedelta(days=days)), str(today - timedelta(days=1))


def history_window(as_of: str | date, days: int = 14) -> tuple[str, str]:
    """Inclusive (start, end) of the last ``days`` days, ``as_of`` included."""
    today = _as_date(as_of)
    return str(today - timedelta(days=days - 1)), str(today)


def date_range(
    df: DataFrame, start: str | None = None, end: str | None = None, column: str = "date"
) -> DataFrame:
    """Rows whose day lies in ``[start, end]``; either bound may be absent.

    On a string or date column the comparison prunes ``date=`` partitions. On a timestamp
    column it becomes a half-open instant range, which Parquet row-group statistics can skip on.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        if start:
            df = df.where(F.col(column) >= F.lit(_as_date(start)).cast(kind))
        if end:
            df = df.where(F.col(column) < F.lit(_as_date(end) + timedelta(days=1)).cast(kind))
        return df
    if isinstance(kind, T.DateType):
        low, high = (F.lit(_as_date(d)) if d else None for d in (start, end))
    else:
        low, high = (F.lit(str(d)) if d else None for d in (start, end))
    if low is not None:
        df = df.where(F.col(column) >= low)
    if high is not None:
        df = df.where(F.col(column) <= high)
    return df


def match_optional(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Equality on each named column whose wanted value is given."""
    for column, value in wanted.items():
        if value is not None and value != "":
            df = df.where(F.col(column) == value)
    return df


def with_labels(df: DataFrame, column: str, labels: tuple[str, ...]) -> DataFrame:
    return df.where(F.col(column).isin(*labels))


def by_severity(alerts: DataFrame, severity: str = "all") -> DataFrame:
    """Air-quality alerts, temperature alerts, or both. Any other word selects nothing."""
    if severity == "all":
        return alerts
    return alerts.where(F.col("alert_type") == _ALERT_TYPE_OF.get(severity, ""))


def search(df: DataFrame, region: str | None = None, query: str | None = None) -> DataFrame:
    """Region equality and a trimmed, case-insensitive substring of the province."""
    df = match_optional(df, region=region)
    needle = (query or "").strip().lower()
    return df.where(F.lower("province").contains(needle)) if needle else df


def breaches(alerts: DataFrame, value: str = "value", threshold: str = "threshold_exceeded") -> DataFrame:
    return alerts.where(F.col(value) / F.col(threshold) > 1)


def not_future(series: DataFrame, as_of_hour: int | Column) -> DataFrame:
    return series.where(F.col("hour") <= as_of_hour)


def clean_records(raw: DataFrame) -> DataFrame:
    """Rows with a temperature, ``date_string`` parsed into ``record_date``."""
    return (
        raw.where(F.col("temp").isNotNull())
        .withColumn("record_date", F.col("date_string").try_cast("date"))
        .drop("date_string")
    )
