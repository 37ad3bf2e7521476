"""Registered queries: projections, filters, scalar rules, named functions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.driver import oracle as o
from aerolith.driver.binding import AS_OF, Binding, query, without_zone
from aerolith.functions import (
    alert_display,
    aqi_alert,
    aqi_category,
    deviation,
    deviation_display,
    exceedance,
    half_away,
    half_even,
    half_up,
    heat_index,
    is_anomaly,
    is_benign,
    pm25_to_aqi,
    register_sql_functions,
    temp_alert,
    weather_condition,
)
from aerolith.functions import rules
from aerolith.operators import filters, joins, projections, ranking, rollups
from aerolith.plans.serving import DAILY_COLUMNS, explode_alerts

_GAPPY_SQL = """gappy AS (SELECT * REPLACE (CASE WHEN event_type <> 'error' THEN pm25 END AS pm25,
 CASE WHEN event_type <> 'click' THEN temperature END AS temperature) FROM readings)"""


def _with_gappy(body: str) -> str:
    return f"WITH {o.READINGS}, {_GAPPY_SQL}\n{body}"


def _gappy(b: Binding) -> DataFrame:
    """Readings where error and click events stand for sensors that gave nothing."""
    return b.readings.withColumns(
        {
            "pm25": F.when(F.col("event_type") != "error", F.col("pm25")),
            "temperature": F.when(F.col("event_type") != "click", F.col("temperature")),
        }
    )


# Projections


@query(
    "p1_rename",
    o.using("readings", "SELECT event_id, timestamp, temperature, humidity FROM readings"),
)
def p1(b: Binding) -> DataFrame:
    feed = b.readings.select(
        "event_id",
        F.col("timestamp").alias("time"),
        F.col("temperature").alias("temp"),
        F.col("humidity").alias("rhum"),
    )
    return projections.rename(feed, projections.HISTORY_NAMES)


@query(
    "p2_to_double",
    """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS double) AS k,
 try_cast(event_type AS double) AS event_type FROM events""",
)
def p2(b: Binding) -> DataFrame:
    text = b.events.select("event_id", F.get_json_object("props", "$.k").alias("k"), "event_type")
    return projections.to_double(text, "k", "event_type")


@query("p3_day_string", "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM events")
def p3(b: Binding) -> DataFrame:
    return projections.with_day(b.events.select("event_id", F.col("ts").alias("timestamp"))).select(
        "event_id", "date"
    )


@query(
    "p4_hour",
    """SELECT event_id, hour(ts)::int AS hour, hour(ts + INTERVAL 7 HOUR)::int AS local_hour FROM events""",
)
def p4(b: Binding) -> DataFrame:
    timed = b.events.select("event_id", F.col("ts").alias("timestamp"))
    local = projections.with_hour(timed, 7).withColumnRenamed("hour", "local_hour")
    return projections.with_hour(local).select("event_id", "hour", "local_hour")


@query(
    "p5_drop_join_key",
    o.using("enriched", "SELECT event_id, station_id, province, region FROM enriched"),
)
def p5(b: Binding) -> DataFrame:
    return b.enriched.select("event_id", "station_id", "province", "region")


@query(
    "p6_local_hours",
    """SELECT event_id, date_trunc('hour', ts) + INTERVAL 7 HOUR AS timestamp,
 date_trunc('hour', ts) + INTERVAL 8 HOUR AS hour_end FROM events""",
)
def p6(b: Binding) -> DataFrame:
    windowed = b.events.select("event_id", F.window("ts", "1 hour").alias("window"))
    return projections.local_hours(windowed, 7)


@query(
    "p7_hour_key",
    o.using(
        "readings",
        "SELECT event_id, station_id || '_' || strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS _id FROM readings",
    ),
)
def p7(b: Binding) -> DataFrame:
    return b.readings.select(
        "event_id", rules.hour_key("station_id", "timestamp").alias("_id")
    )


@query(
    "p8_serving_aliases",
    o.using(
        "windows",
        """SELECT station_id, hour_start, avg_temp, avg_humidity, avg_pm25, avg_no2, avg_aqi,
 avg_temp AS temperature, avg_humidity AS humidity, avg_pm25 AS pm25, avg_no2 AS no2, avg_aqi AS aqi_index FROM windows""",
    ),
)
def p8(b: Binding) -> DataFrame:
    windowed = b.windows.select(
        "station_id",
        F.col("window.start").alias("hour_start"),
        "avg_temp",
        "avg_humidity",
        "avg_pm25",
        "avg_no2",
        "avg_aqi",
    )
    return projections.serving_aliases(windowed)


@query(
    "p10_struct_field",
    o.using("daily", "SELECT date, station_id, peak_aqi_hour FROM daily"),
)
def p10(b: Binding) -> DataFrame:
    peak = rollups.peak_struct(rules.pm25_to_aqi_sql("pm25"), "hour(timestamp)")
    grouped = rollups.render_date(b.days.groupBy("date", "station_id").agg(peak.alias("peak")))
    return grouped.withColumn("peak_aqi_hour", F.col("peak.hour")).drop("peak")


@query(
    "p11_endpoint_columns",
    o.using("daily", "SELECT date, avg_temp, max_temp, min_temp, avg_pm25, avg_aqi, peak_aqi_hour FROM daily"),
)
def p11(b: Binding) -> DataFrame:
    return b.daily.select(*DAILY_COLUMNS)


@query(
    "p12_display_shape",
    o.using(
        "realtime",
        f"""SELECT station_id, province, region, temperature AS temp, humidity, pm25 AS pm2_5, no2, aqi_index AS aqi_value,
 {o.aqi_alert('aqi_index', 'Unhealthy (SG)')} AS aqi_category, aqi_alert, temp_alert,
 aqi_alert IN ('Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous')
  OR temp_alert IN ('Extreme Heat', 'Too Cold') AS is_anomaly, timestamp FROM realtime""",
    ),
)
def p12(b: Binding) -> DataFrame:
    return projections.display_shape(b.realtime)


@query(
    "p12_display_series",
    o.using(
        "hourly",
        """SELECT h.station_id, h.timestamp AS time, hour(h.timestamp)::int AS hour, temperature AS temp, humidity,
 pm25 AS pm2_5, aqi_index AS aqi_value FROM hourly h
 JOIN (SELECT station_id, max(date) AS date FROM hourly GROUP BY station_id) d
 ON h.station_id = d.station_id AND h.date = d.date""",
    ),
)
def p12_series(b: Binding) -> DataFrame:
    return projections.display_series(b.serving("hourly").hourly_all())


@query(
    "p12_display_history",
    o.using("daily", "SELECT station_id, date, avg_temp, max_temp, min_temp, avg_aqi, peak_aqi_hour FROM daily"),
)
def p12_history(b: Binding) -> DataFrame:
    return projections.display_history(b.daily)


@query(
    "p13_stamp_ingestion",
    f"""SELECT event_id, value AS pm25, TIMESTAMP '{AS_OF} 06:30:00' AS timestamp, '{AS_OF}' AS date FROM events""",
)
def p13(b: Binding) -> DataFrame:
    arriving = b.readings.select("event_id", "pm25")
    stamped = projections.stamp_ingestion(arriving, datetime.fromisoformat(f"{AS_OF} 06:30:00"))
    return without_zone(stamped)


# Filters


@query(
    "f1_date_range",
    o.using(
        "readings",
        "SELECT event_id, station_id, date FROM readings WHERE date >= '2024-01-10' AND date <= '2024-01-20'",
    ),
)
def f1(b: Binding) -> DataFrame:
    wanted = filters.date_range(b.readings, "2024-01-10", "2024-01-20", column="timestamp")
    return wanted.select("event_id", "station_id", "date")


@query(
    "f2_match_optional",
    o.using(
        "enriched",
        "SELECT event_id, station_id, province FROM enriched WHERE province = (SELECT min(n_name) FROM nation)",
    ),
)
def f2(b: Binding) -> DataFrame:
    province = b.table("nation").agg(F.min("n_name")).first()[0]
    return filters.match_optional(b.enriched, station_id=None, province=province).select(
        "event_id", "station_id", "province"
    )


@query(
    "f3_alert_labels",
    o.using(
        "labelled",
        """SELECT event_id, aqi_alert, temp_alert FROM labelled
 WHERE aqi_alert IN ('Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous')
 AND temp_alert IN ('Hot', 'Extreme Heat', 'Too Cold')""",
    ),
)
def f3(b: Binding) -> DataFrame:
    both = filters.with_labels(
        filters.with_labels(b.labelled, "aqi_alert", rules.ALERT_AQI), "temp_alert", rules.ALERT_TEMP
    )
    return both.select("event_id", "aqi_alert", "temp_alert")


@query(
    "f4_severity",
    o.using("alerts", "SELECT station_id, level, value FROM alerts WHERE alert_type = 'Temperature'"),
)
def f4(b: Binding) -> DataFrame:
    return filters.by_severity(explode_alerts(b.realtime), "temp").select("station_id", "level", "value")


@query(
    "f5_search",
    o.using(
        "stations",
        "SELECT station_id, province, region FROM stations WHERE region = 'ASIA' AND contains(lower(province), 'n_1')",
    ),
)
def f5(b: Binding) -> DataFrame:
    return filters.search(b.stations, "ASIA", "  N_1 ")


@query(
    "f6_breaches",
    o.using(
        "alerts",
        """SELECT station_id, alert_type, value FROM alerts
 WHERE value / CASE WHEN alert_type = 'Air Quality' THEN 150 ELSE 35 END > 1""",
    ),
)
def f6(b: Binding) -> DataFrame:
    alerts = explode_alerts(b.realtime)
    _, threshold = alert_display()
    return filters.breaches(alerts.withColumn("threshold_exceeded", threshold)).select(
        "station_id", "alert_type", "value"
    )


@query("f7_not_future", "SELECT event_id, hour(ts)::int AS hour FROM events WHERE hour(ts) <= 13")
def f7(b: Binding) -> DataFrame:
    return filters.not_future(projections.with_hour(b.readings), 13).select("event_id", "hour")


@query(
    "f8_clean_records",
    _with_gappy(
        "SELECT event_id, temperature AS temp, date::date AS record_date FROM gappy WHERE temperature IS NOT NULL"
    ),
)
def f8(b: Binding) -> DataFrame:
    raw = _gappy(b).select(
        "event_id", F.col("temperature").alias("temp"), F.col("date").alias("date_string")
    )
    return filters.clean_records(raw)


@query(
    "f10_history_window",
    o.using(
        "daily",
        "SELECT station_id, date, avg_temp FROM daily WHERE date BETWEEN '2024-01-17' AND '2024-01-30'",
    ),
)
def f10(b: Binding) -> DataFrame:
    start, end = filters.history_window("2024-01-30")
    return b.daily_between(start, end).select("station_id", "date", "avg_temp")


# Scalar rules


@query(
    "x1_pm25_to_aqi",
    _with_gappy(
        f"SELECT event_id, {o.aqi('pm25')} AS aqi, {o.aqi('pm25', 'NULL')} AS serving_aqi FROM gappy"
    ),
)
def x1(b: Binding) -> DataFrame:
    return _gappy(b).select(
        "event_id", pm25_to_aqi("pm25").alias("aqi"), pm25_to_aqi("pm25", "null").alias("serving_aqi")
    )


@query(
    "x2_aqi_alert",
    o.using("labelled", "SELECT event_id, aqi_alert FROM labelled"),
)
def x2(b: Binding) -> DataFrame:
    return b.labelled.select("event_id", aqi_alert("aqi_index").alias("aqi_alert"))


@query(
    "x3_temp_alert",
    _with_gappy(
        f"""SELECT event_id, {o.temp_alert('temperature')} AS temp_alert,
 coalesce({o.temp_alert('temperature')}, 'Extreme Heat') AS fallthrough,
 coalesce({o.temp_alert('temperature')}, 'Normal') AS lenient FROM gappy"""
    ),
)
def x3(b: Binding) -> DataFrame:
    t = "temperature"
    return _gappy(b).select(
        "event_id",
        temp_alert(t).alias("temp_alert"),
        temp_alert(t, "fallthrough").alias("fallthrough"),
        temp_alert(t, "normal").alias("lenient"),
    )


@query(
    "x4_heat_index",
    _with_gappy(
        f"SELECT event_id, {o.half_up('temperature + 0.05::double * humidity', 1)} AS heat_index FROM gappy"
    ),
)
def x4(b: Binding) -> DataFrame:
    return _gappy(b).select(
        "event_id", heat_index("temperature", "humidity").alias("heat_index")
    )


@query(
    "x5_weather_condition",
    _with_gappy(
        """SELECT event_id, CASE WHEN pm25 > 150 THEN 'Hazardous' WHEN temperature > 35 THEN 'Extreme Heat'
 ELSE 'Normal' END AS weather_condition FROM gappy"""
    ),
)
def x5(b: Binding) -> DataFrame:
    return _gappy(b).select(
        "event_id",
        weather_condition("pm25", "temperature").alias("weather_condition"),
    )


@query(
    "x6_aqi_category",
    o.using(
        "labelled", f"SELECT event_id, {o.aqi_alert('aqi_index', 'Unhealthy (SG)')} AS aqi_category FROM labelled"
    ),
)
def x6(b: Binding) -> DataFrame:
    return b.labelled.select("event_id", aqi_category("aqi_index").alias("aqi_category"))


@query(
    "x7_is_anomaly",
    o.using(
        "labelled",
        """SELECT event_id, aqi_alert IN ('Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous')
  OR temp_alert IN ('Extreme Heat', 'Too Cold') AS is_anomaly FROM labelled""",
    ),
)
def x7(b: Binding) -> DataFrame:
    return b.labelled.select(
        "event_id", is_anomaly("aqi_alert", "temp_alert").alias("is_anomaly")
    )


@query(
    "x8_deviations",
    o.using(
        "compare",
        f"""SELECT station_id, temp_deviation, pm25_deviation,
 current_aqi - {o.aqi('historical_avg_pm25', 'NULL')} AS aqi_deviation FROM compare""",
    ),
)
def x8(b: Binding) -> DataFrame:
    joined = joins.current_against_baseline(b.realtime, b.summary)
    historical = pm25_to_aqi("historical_avg_pm25", "null")
    return joined.select(
        "station_id",
        deviation("temperature", "historical_avg_temp", 1).alias("temp_deviation"),
        deviation("pm25", "historical_avg_pm25", 2).alias("pm25_deviation"),
        (F.col("aqi_index") - historical).alias("aqi_deviation"),
    )


@query(
    "x9_alert_display",
    o.using(
        "alerts",
        """SELECT station_id, CASE WHEN alert_type = 'Temperature' THEN 'Heatwave' WHEN level = 'Hazardous'
 THEN 'AQI Hazardous' ELSE 'Pollution Spike' END AS shown,
 CASE WHEN alert_type = 'Air Quality' THEN 150 ELSE 35 END AS threshold FROM alerts""",
    ),
)
def x9(b: Binding) -> DataFrame:
    shown, threshold = alert_display()
    return explode_alerts(b.realtime).select(
        "station_id", shown.alias("shown"), threshold.alias("threshold")
    )


@query(
    "x10_alert_fan_out",
    f"""WITH {o.READINGS}, {o.STATIONS}, {o.RATED}, realtime AS (SELECT * FROM rated), {o.ALERTS}
SELECT * FROM alerts""",
)
def x10(b: Binding) -> DataFrame:
    return explode_alerts(b.rated)


@query(
    "x11_exceedance",
    o.using(
        "alerts",
        """SELECT station_id, alert_type, value / t AS ratio, floor(value / t * 100 + 0.5::double)::int AS percent
 FROM (SELECT *, CASE WHEN alert_type = 'Air Quality' THEN 150 ELSE 35 END AS t FROM alerts)""",
    ),
)
def x11(b: Binding) -> DataFrame:
    _, threshold = alert_display()
    ratio, percent = exceedance("value", "threshold")
    return explode_alerts(b.realtime).withColumn("threshold", threshold).select(
        "station_id", "alert_type", ratio.alias("ratio"), percent.alias("percent")
    )


@query(
    "x12_deviation_display",
    o.using(
        "compare",
        """SELECT station_id, CASE WHEN temp_deviation = 0 THEN '→' WHEN temp_deviation > 0 THEN '↑' ELSE '↓' END AS direction,
 coalesce(temp_deviation > 0, false) AS worse,
 CASE WHEN historical_avg_temp IS NULL OR historical_avg_temp = 0 THEN 1.0::double
  ELSE least(1.5::double, coalesce(current_temp, 0) / historical_avg_temp) END AS ratio FROM compare""",
    ),
)
def x12(b: Binding) -> DataFrame:
    joined = joins.current_against_baseline(b.realtime, b.summary)
    current, baseline = "temperature", "historical_avg_temp"
    shown = deviation_display(current, baseline, rules.deviation_sql(current, baseline, 1))
    return joined.select(
        "station_id", *[c.alias(n) for c, n in zip(shown, ("direction", "worse", "ratio"), strict=True)]
    )


@query(
    "x14_half_up",
    f"""SELECT event_id, {o.half_up('value', 1)} AS one, {o.half_up('value', 0)} AS whole,
 {o.half_up('-value', 1)} AS negative FROM events""",
)
def x14(b: Binding) -> DataFrame:
    return b.events.select(
        "event_id",
        half_up("value", 1).alias("one"),
        half_up("value", 0).alias("whole"),
        half_up("-value", 1).alias("negative"),
    )


@query(
    "x15_half_away",
    f"""SELECT event_id, {o.half_away('value', 1)} AS one, {o.half_away('value', 0)} AS whole,
 {o.half_away('-value', 1)} AS negative FROM events""",
)
def x15(b: Binding) -> DataFrame:
    return b.events.select(
        "event_id",
        half_away("value", 1).alias("one"),
        half_away("value", 0).alias("whole"),
        half_away("-value", 1).alias("negative"),
    )


@query(
    "x16_half_even",
    """SELECT event_id, (c // 10 + CASE WHEN c % 10 > 5 OR (c % 10 = 5 AND (c // 10) % 2 = 1) THEN 1 ELSE 0 END)::double
  / 10.0::double AS one FROM (SELECT event_id, cast(round(value * 100) AS bigint) AS c FROM events)""",
)
def x16(b: Binding) -> DataFrame:
    return b.events.select("event_id", half_even("value", 1).alias("one"))


@query(
    "x19_compose_timestamp",
    "SELECT event_id, date_trunc('hour', ts) AS hour_start FROM events",
)
def x19(b: Binding) -> DataFrame:
    composed = rules.compose_timestamp("date", "hour(timestamp)")
    return b.readings.select("event_id", composed.alias("hour_start"))


@query(
    "x20_is_benign",
    o.using(
        "labelled",
        """SELECT event_id, aqi_alert IN ('Good', 'Moderate', 'Normal') AS air_benign,
 temp_alert IN ('Good', 'Moderate', 'Normal') AS temp_benign FROM labelled""",
    ),
)
def x20(b: Binding) -> DataFrame:
    return b.labelled.select(
        "event_id",
        is_benign("aqi_alert").alias("air_benign"),
        is_benign("temp_alert").alias("temp_benign"),
    )


# Named functions and SQL text


@query(
    "d1_calculate_heat_index",
    _with_gappy(
        f"SELECT event_id, {o.half_up('temperature + 0.05::double * humidity', 1)} AS heat_index FROM gappy"
    ),
)
def d1(b: Binding) -> DataFrame:
    register_sql_functions(b.spark)
    return _gappy(b).selectExpr("event_id", "calculateHeatIndex(temperature, humidity) AS heat_index")


@query("d2_pm25_to_aqi", _with_gappy(f"SELECT event_id, {o.aqi('pm25')} AS aqi FROM gappy"))
def d2(b: Binding) -> DataFrame:
    register_sql_functions(b.spark)
    return _gappy(b).selectExpr("event_id", "pm25ToAQI(pm25) AS aqi")


@query(
    "d3_sql_text",
    o.using(
        "enriched",
        """SELECT region, date, count(*) AS readings, max(temperature) AS max_temp FROM enriched
 WHERE pm25 > 12 GROUP BY region, date""",
    ),
)
def d3(b: Binding) -> DataFrame:
    b.enriched.createOrReplaceTempView("aerolith_weather")
    return b.spark.sql(
        "SELECT region, date, count(*) AS readings, max(temperature) AS max_temp "
        "FROM aerolith_weather WHERE pm25 > 12 GROUP BY region, date"
    )
