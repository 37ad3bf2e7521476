"""Daily, summary, hourly and national aggregates.

Every buffer here is a fixed-width number, so Spark plans hash aggregation with map-side
combining: a station that holds a third of the rows still reaches each reducer as one row per
task. The hour of the day's peak is found by the maximum of ``index * 32 + hour code`` for the
same reason; ``max(struct(..))`` would sort every row first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions import rules
from aerolith.functions.rounding import (
    half_up,
    mean,
    mean_of_sum_sql,
    mean_of_units_sql,
    units_sql,
)

DAILY_KEYS = ("date", "station_id", "province", "region")
SUMMARY_KEYS = ("station_id", "province", "region")
_MEASURES = {"temp": "temperature", "humidity": "humidity", "pm25": "pm25", "no2": "no2"}
_SCALE = 6
_HOUR_CODES = 32


def pack_peak_sql(aqi: str, hour: str, tie: str = "latest") -> str:
    """Number that orders like (aqi, hour) or, for ``tie='first'``, like (aqi, -hour)."""
    code = f"{hour} + 1" if tie == "latest" else f"{_HOUR_CODES - 1} - {hour}"
    return f"CAST({aqi} AS BIGINT) * {_HOUR_CODES}L + coalesce({code}, 0)"


def unpack_peak_hour_sql(packed: str, tie: str = "latest") -> str:
    code = f"nullif(pmod({packed}, {_HOUR_CODES}L), 0L)"
    hour = f"{code} - 1" if tie == "latest" else f"{_HOUR_CODES - 1} - {code}"
    return f"CAST({hour} AS INT)"


def peak_hour(aqi: str, hour: str, tie: str = "latest", empty: int | None = None) -> Column:
    """Aggregate: hour of the greatest index; ties go to the latest or the first such hour."""
    found = unpack_peak_hour_sql(f"max({pack_peak_sql(aqi, hour, tie)})", tie)
    return F.expr(found if empty is None else f"coalesce({found}, {empty})")


def peak_struct(aqi: str, hour: str) -> Column:
    """Aggregate: (aqi, hour) of the greatest index, the latest such hour on ties."""
    top = f"max({pack_peak_sql(aqi, hour)})"
    index = f"CAST(floor({top} / {_HOUR_CODES}) AS INT)"
    return F.expr(f"named_struct('aqi', {index}, 'hour', {unpack_peak_hour_sql(top)})")


def render_date(df: DataFrame) -> DataFrame:
    """Days leave as strings; grouping on a DateType costs less than on text."""
    if "date" in df.columns and isinstance(df.schema["date"].dataType, T.DateType):
        return df.withColumn("date", rules.day_string("date"))
    return df


def daily_partials(
    readings: DataFrame,
    keys: Sequence[str] = ("date", "station_id"),
    how: str = "fixed",
    aqi_null: str = "zero",
    tz_offset_hours: int = 0,
) -> DataFrame:
    """Additive daily state (sums, counts, extremes, packed peak) of raw readings.

    Daily and summary views both follow from it, so the raw data is read once for the two.
    """
    aqi = rules.pm25_to_aqi_sql("pm25", aqi_null)
    hour = f"hour({rules.shift_hours_sql('timestamp', tz_offset_hours)})"
    sums = []
    for name, x in _MEASURES.items():
        addend = units_sql(x, _SCALE) if how == "fixed" else x
        sums += [f"sum({addend}) AS sum_{name}", f"count({x}) AS n_{name}"]
    rated = readings.withColumn("_aqi", F.expr(aqi))
    state = [
        *sums,
        "max(temperature) AS max_temp",
        "min(temperature) AS min_temp",
        "sum(_aqi) AS sum_aqi",
        "count(_aqi) AS n_aqi",
        f"max({pack_peak_sql('_aqi', hour)}) AS peak",
        "count(*) AS record_count",
    ]
    return rated.groupBy(*keys).agg(*[F.expr(x) for x in state])


def _mean_of_partials(name: str, digits: int, how: str, scale: int = _SCALE, merge: bool = False) -> Column:
    total, n = f"sum_{name}", f"n_{name}"
    if merge:
        total, n = f"sum({total})", f"sum({n})"
    rounded = (
        mean_of_units_sql(total, n, digits, scale) if how == "fixed" else mean_of_sum_sql(total, n, digits)
    )
    return F.expr(f"{rounded} AS avg_{name}")


def daily_from_partials(partials: DataFrame, how: str = "fixed") -> DataFrame:
    keys = [c for c in DAILY_KEYS if c in partials.columns]
    return render_date(
        partials.select(
            *keys,
            _mean_of_partials("temp", 1, how),
            F.round("max_temp", 1).alias("max_temp"),
            F.round("min_temp", 1).alias("min_temp"),
            _mean_of_partials("humidity", 1, how),
            _mean_of_partials("pm25", 2, how),
            _mean_of_partials("no2", 2, how),
            _mean_of_partials("aqi", 0, how, scale=0),
            F.expr(f"{unpack_peak_hour_sql('peak')} AS peak_aqi_hour"),
            "record_count",
        )
    )


def summary_from_partials(
    partials: DataFrame, how: str = "fixed", keys: Sequence[str] = ("station_id",)
) -> DataFrame:
    return partials.groupBy(*keys).agg(
        _mean_of_partials("temp", 1, how, merge=True),
        F.round(F.max("max_temp"), 1).alias("max_temp"),
        _mean_of_partials("humidity", 1, how, merge=True),
        _mean_of_partials("pm25", 2, how, merge=True),
        _mean_of_partials("no2", 2, how, merge=True),
        F.sum("record_count").alias("record_count"),
    )


def daily_rollup(enriched: DataFrame, how: str = "fixed", **options) -> DataFrame:
    """Per day and station: temperature, humidity, pm25, no2 and index statistics, peak hour, rows."""
    return daily_from_partials(daily_partials(enriched, DAILY_KEYS, how, **options), how)


def station_summary(enriched: DataFrame, how: str = "fixed") -> DataFrame:
    """Per station over all its days."""
    return enriched.groupBy(*SUMMARY_KEYS).agg(
        mean("temperature", 1, how).alias("avg_temp"),
        F.round(F.max("temperature"), 1).alias("max_temp"),
        mean("humidity", 1, how).alias("avg_humidity"),
        mean("pm25", 2, how).alias("avg_pm25"),
        mean("no2", 2, how).alias("avg_no2"),
        F.count("*").alias("record_count"),
    )


def complete_daily(complete: DataFrame, how: str = "fixed") -> DataFrame:
    """Daily rollup of complete days: whole-number humidity, first peak hour, counted temperatures."""
    rated = complete.withColumn("_aqi", rules.pm25_to_aqi("pm25", "null"))
    return render_date(
        rated.groupBy(*DAILY_KEYS).agg(
            mean("temperature", 1, how, ties="up").alias("avg_temp"),
            half_up("max(temperature)", 1).alias("max_temp"),
            half_up("min(temperature)", 1).alias("min_temp"),
            mean("humidity", 0, how, ties="up").alias("avg_humidity"),
            mean("pm25", 2, how, ties="up").alias("avg_pm25"),
            mean("no2", 2, how, ties="up").alias("avg_no2"),
            half_up("avg(_aqi)", 0).alias("avg_aqi"),
            peak_hour("_aqi", "slot", tie="first", empty=0).alias("peak_aqi_hour"),
            F.count("temperature").alias("record_count"),
        )
    )


def complete_summary(complete: DataFrame, how: str = "fixed") -> DataFrame:
    """Per-station summary of complete days."""
    return complete.groupBy(*SUMMARY_KEYS).agg(
        mean("temperature", 1, how, ties="up").alias("avg_temp"),
        half_up("max(temperature)", 1).alias("max_temp"),
        mean("humidity", 0, how, ties="up").alias("avg_humidity"),
        mean("pm25", 2, how, ties="up").alias("avg_pm25"),
        mean("no2", 2, how, ties="up").alias("avg_no2"),
        F.count("temperature").alias("record_count"),
    )


def hourly_rollup(
    rated: DataFrame,
    width: str = "1 hour",
    keys: Sequence[str] = ("station_id", "province"),
    how: str = "fixed",
) -> DataFrame:
    """Tumbling-window statistics per station, on a stream or a table alike."""

    def spread(x: str, name: str, digits: int) -> list[Column]:
        return [
            mean(x, digits, how).alias(f"avg_{name}"),
            F.expr(f"round(max({x}), {digits}) AS max_{name}"),
            F.expr(f"round(min({x}), {digits}) AS min_{name}"),
        ]

    return rated.groupBy(F.window("timestamp", width), *keys).agg(
        *spread("pm25", "pm25", 2),
        *spread("temperature", "temp", 1),
        *spread("humidity", "humidity", 1),
        mean("no2", 2, how).alias("avg_no2"),
        F.round(F.avg("aqi_index"), 0).alias("avg_aqi"),
        F.max("aqi_index").alias("max_aqi"),
    )


def national_means(summary: DataFrame, how: str = "fixed") -> DataFrame:
    """One row: the mean of the stations' means, ties to even; null for an empty summary."""
    return summary.agg(
        mean("avg_temp", 2, how, ties="even").alias("national_avg_temp"),
        mean("avg_pm25", 2, how, ties="even").alias("national_avg_pm25"),
    )


def region_max_temperature(lines: DataFrame, key: str = "region") -> DataFrame:
    """Greatest temperature per region (or other ``key``) of ``date,region,temp,humidity`` text lines.

    A header line and lines without exactly four fields are skipped; trailing empty fields do
    not count.
    """
    fields = F.split(F.regexp_replace("value", ",+$", ""), ",")
    return (
        lines.select(fields.alias("f"))
        .where((F.size("f") == 4) & (F.col("f")[0] != "date"))
        .groupBy(F.col("f")[1].alias(key))
        .agg(F.max(F.col("f")[2].try_cast("double")).alias("max_temp"))
    )


def region_max_of_stations(highest: DataFrame, stations: DataFrame) -> DataFrame:
    """Greatest temperature per region from the greatest per station: the lookup sees one row per station."""
    known = highest.join(stations.select("station_id", "region"), "station_id")
    return known.groupBy("region").agg(F.max("max_temp").alias("max_temp"))


def region_weather(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Mean ``temp`` and total ``precipitation`` per region, warmest first.

    Readings are summed per station before the lookup, so a region that holds most rows is a few
    sums by then. Readings of unknown stations count under a null region.
    """
    sums = readings.groupBy("station_id").agg(
        F.sum("temp").alias("_sum"), F.count("temp").alias("_n"), F.sum("precipitation").alias("_total")
    )
    return (
        sums.join(stations.select("station_id", "region"), "station_id", "left")
        .groupBy("region")
        .agg(
            F.try_divide(F.sum("_sum"), F.sum("_n")).alias("avg_temperature"),
            F.sum("_total").alias("total_precipitation"),
        )
        .orderBy(F.desc("avg_temperature"))
    )


def last_updated(df: DataFrame) -> DataFrame:
    return df.agg(F.max("timestamp").alias("last_updated"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))
