"""Air-quality and weather rules as SQL expressions (no Python in the plan).

Arguments are column names or SQL text; a ``*_sql`` function gives the text, its namesake the
column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolith.functions.rounding import half_up_sql

# PM2.5 concentration breakpoints and the index range of each segment
# (concentration low, concentration high, index low, index high); above the last: 500.
PM25_SEGMENTS = (
    (0.0, 12.0, 0.0, 50.0),
    (12.1, 35.4, 51.0, 100.0),
    (35.5, 55.4, 101.0, 150.0),
    (55.5, 150.4, 151.0, 200.0),
    (150.5, 250.4, 201.0, 300.0),
    (250.5, 350.4, 301.0, 400.0),
    (350.5, 500.4, 401.0, 500.0),
)
AQI_CEILING = 500

# Upper bound of each index band, its alert label and its display label.
AQI_BANDS = (
    (50, "Good", "Good"),
    (100, "Moderate", "Moderate"),
    (150, "Unhealthy for Sensitive Groups", "Unhealthy (SG)"),
    (200, "Unhealthy", "Unhealthy"),
    (300, "Very Unhealthy", "Very Unhealthy"),
)
AQI_TOP_BAND = "Hazardous"

# Label sets of the serving queries.
ALERT_AQI = ("Unhealthy for Sensitive Groups", "Unhealthy", "Very Unhealthy", "Hazardous")
ALERT_TEMP = ("Hot", "Extreme Heat", "Too Cold")
ANOMALY_TEMP = ("Extreme Heat", "Too Cold")
BENIGN = ("Good", "Moderate", "Normal")

# Display thresholds of the two alert families.
AQI_THRESHOLD = 150
TEMP_THRESHOLD = 35


def _case(arms: Sequence[tuple[str, str]], otherwise: str) -> str:
    return f"CASE {' '.join(f'WHEN {c} THEN {v}' for c, v in arms)} ELSE {otherwise} END"


def _among(x: str, labels: Sequence[str]) -> str:
    listed = ", ".join(f"'{label}'" for label in labels)
    return f"coalesce({x} IN ({listed}), false)"


def pm25_to_aqi_sql(pm25: str, null_policy: str = "zero") -> str:
    """Integer air-quality index of a PM2.5 concentration.

    A null concentration gives 0 (``null_policy='zero'``, pipelines) or null (``'null'``, serving).
    """
    empty = {"zero": "0", "null": "NULL"}.get(null_policy)
    if empty is None:
        raise ValueError(f"unknown null_policy {null_policy!r}")
    arms = [(f"{pm25} IS NULL", empty)]
    for low, high, index_low, index_high in PM25_SEGMENTS:
        slope = (index_high - index_low) / (high - low)
        exact = f"{slope!r}D * ({pm25} - {low!r}D) + {index_low!r}D"
        arms.append((f"{pm25} <= {high!r}D", f"try_cast(floor({exact} + 0.5D) AS INT)"))
    return _case(arms, str(AQI_CEILING))


def _band_sql(aqi: str, label: int) -> str:
    return _case([(f"{aqi} <= {band[0]}", f"'{band[label]}'") for band in AQI_BANDS], f"'{AQI_TOP_BAND}'")


def _nullable_sql(x: str, label: str, null_policy: str) -> str:
    if null_policy == "null":
        return f"CASE WHEN {x} IS NOT NULL THEN {label} END"
    if null_policy == "fallthrough":
        return label
    raise ValueError(f"unknown null_policy {null_policy!r}")


def heat_index_sql(temperature: str, humidity: str) -> str:
    return half_up_sql(f"{temperature} + 0.05D * {humidity}", 1)


def pm25_to_aqi(pm25: str, null_policy: str = "zero") -> Column:
    return F.expr(pm25_to_aqi_sql(pm25, null_policy))


def aqi_alert(aqi: str, null_policy: str = "null") -> Column:
    """Alert label of an index. ``'fallthrough'`` sends null to the top band, as a bare CASE does."""
    return F.expr(_nullable_sql(aqi, _band_sql(aqi, 1), null_policy))


def aqi_category(aqi: str, null_policy: str = "null") -> Column:
    """Short display label of an index."""
    return F.expr(_nullable_sql(aqi, _band_sql(aqi, 2), null_policy))


def temp_alert(t: str, null_policy: str = "null") -> Column:
    """Alert label of a temperature; ``'normal'`` reads a missing temperature as Normal."""
    arms = [(f"{t} < 10", "'Too Cold'"), (f"{t} <= 35", "'Normal'"), (f"{t} <= 40", "'Hot'")]
    if null_policy == "normal":
        return F.expr(_case([(f"{t} IS NULL", "'Normal'"), *arms], "'Extreme Heat'"))
    return F.expr(_nullable_sql(t, _case(arms, "'Extreme Heat'"), null_policy))


def heat_index(temperature: str, humidity: str) -> Column:
    return F.expr(heat_index_sql(temperature, humidity))


def weather_condition(pm25: str, temperature: str) -> Column:
    arms = [(f"{pm25} > 150", "'Hazardous'"), (f"{temperature} > 35", "'Extreme Heat'")]
    return F.expr(_case(arms, "'Normal'"))


def is_anomaly(aqi_label: str, temp_label: str) -> Column:
    return F.expr(f"{_among(aqi_label, ALERT_AQI)} OR {_among(temp_label, ANOMALY_TEMP)}")


def is_benign(label: str) -> Column:
    return F.expr(_among(label, BENIGN))


def deviation_sql(current: str, baseline: str, digits: int) -> str:
    """Signed difference, half-up; null when either side is."""
    return half_up_sql(f"{current} - {baseline}", digits)


def deviation(current: str, baseline: str, digits: int) -> Column:
    return F.expr(deviation_sql(current, baseline, digits))


def deviation_display(
    current: str, baseline: str, dev: str, higher_is_worse: bool = True
) -> tuple[Column, Column, Column]:
    """(direction, worse, ratio) of a deviation; the ratio stops at 1.5 and is 1 without a baseline."""
    up = f"coalesce({dev} > 0, false)"
    flat = f"coalesce({dev} = 0, false)"
    direction = _case([(flat, "'→'"), (up, "'↑'")], "'↓'")
    worse = _case([(flat, "false")], up if higher_is_worse else f"NOT {up}")
    share = f"least(1.5D, try_divide(coalesce({current}, 0D), {baseline}))"
    ratio = _case([(f"{baseline} IS NULL OR {baseline} = 0", "1.0D")], share)
    return F.expr(direction), F.expr(worse), F.expr(ratio)


def alert_display(alert_type: str = "alert_type", level: str = "level") -> tuple[Column, Column]:
    """(display type, threshold) of an alert. Every temperature alert, cold ones too, shows as Heatwave."""
    air = f"{alert_type} = 'Air Quality'"
    shown = _case(
        [(f"{air} AND {level} = 'Hazardous'", "'AQI Hazardous'"), (air, "'Pollution Spike'")], "'Heatwave'"
    )
    return F.expr(shown), F.expr(_case([(air, str(AQI_THRESHOLD))], str(TEMP_THRESHOLD)))


def exceedance(value: str, threshold: str) -> tuple[Column, Column]:
    """(ratio, whole percent) of a value against its threshold."""
    ratio = f"{value} / {threshold}"
    return F.expr(ratio), F.expr(f"CAST(floor({ratio} * 100 + 0.5D) AS INT)")


def day_string(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def shift_hours_sql(ts: str, hours: int) -> str:
    return f"{ts} + INTERVAL '{int(hours)}' HOUR" if hours else ts


def hour_key(station: str, ts: str) -> Column:
    """Stable row key of a station-hour."""
    return F.expr(f"concat_ws('_', {station}, date_format({ts}, 'yyyy-MM-dd HH:mm:ss'))")


def compose_timestamp(date: str, hour: str) -> Column:
    """Timestamp without zone from a day string and an hour, the hour padded to two digits."""
    return F.expr(
        f"CAST(concat(CAST({date} AS STRING), ' ', lpad(CAST({hour} AS STRING), 2, '0'), ':00:00') AS TIMESTAMP_NTZ)"
    )
