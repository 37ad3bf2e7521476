"""Registered queries: joins, aggregates, time series, sorting and set operations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.driver import oracle as o
from aerolith.driver.binding import HOW, TIEBREAK, Binding, query
from aerolith.functions.rules import pm25_to_aqi_sql
from aerolith.operators import complete, joins, latest, projections, ranking, rollups
from aerolith.operators.filters import date_range, rolling_window
from aerolith.plans import daily_state
from aerolith.plans.serving import explode_alerts
from aerolith.sources.lake import union_readings

ANCHOR = "2026-06-01"
NOW = datetime.fromisoformat("2026-06-02 13:20:00")


# Joins


@query(
    "j1_left_enrich",
    o.using("enriched", "SELECT event_id, station_id, province, region, pm25, temperature FROM enriched"),
)
def j1(b: Binding) -> DataFrame:
    merged = joins.enrich_left(b.readings, b.stations, strategy="skew")
    return merged.select("event_id", "station_id", "province", "region", "pm25", "temperature")


@query(
    "j2_inner_enrich",
    o.using(
        "readings stations",
        """SELECT event_id, r.station_id, s.province
 FROM (SELECT event_id, CASE event_type WHEN 'error' THEN 'X' || station_id WHEN 'click' THEN NULL ELSE station_id END AS station_id
  FROM readings) r JOIN stations s ON r.station_id = s.station_id""",
    ),
)
def j2(b: Binding) -> DataFrame:
    return joins.enrich_inner(b.strange, b.stations).select("event_id", "station_id", "province")


@query(
    "j3_current_against_baseline",
    o.using(
        "compare",
        "SELECT station_id, current_temp, historical_avg_temp, current_pm25, historical_avg_pm25 FROM compare",
    ),
)
def j3(b: Binding) -> DataFrame:
    return joins.current_against_baseline(b.realtime, b.summary).select(
        "station_id",
        F.col("temperature").alias("current_temp"),
        "historical_avg_temp",
        F.col("pm25").alias("current_pm25"),
        "historical_avg_pm25",
    )


@query(
    "j4_merge_feeds",
    o.using(
        "station_hours",
        f"""SELECT coalesce(f.station_id, a.station_id, q.station_id) AS station_id,
 coalesce(f.time, a.time, q.time) AS time,
 {o.half_up('coalesce(f.temperature, a.temperature)', 1)} AS temperature,
 {o.half_up('coalesce(f.humidity, a.humidity)', 0)} AS humidity,
 {o.half_up('q.pm25', 1)} AS pm25, {o.half_up('q.no2', 1)} AS no2
FROM (SELECT station_id, timestamp AS time, CASE WHEN humidity < 60 THEN temperature END AS temperature, humidity
  FROM station_hours WHERE date >= '2024-01-10') f
FULL JOIN (SELECT station_id, timestamp AS time, temperature - 1.0::double AS temperature, humidity FROM station_hours
  WHERE date <= '2024-01-25') a ON f.station_id = a.station_id AND f.time = a.time
FULL JOIN (SELECT station_id, timestamp AS time, pm25, no2 FROM station_hours) q
 ON coalesce(f.station_id, a.station_id) = q.station_id AND coalesce(f.time, a.time) = q.time""",
    ),
)
def j4(b: Binding) -> DataFrame:
    hours = b.station_hours.withColumnRenamed("timestamp", "time")
    forecast = hours.where(F.col("date") >= "2024-01-10").withColumn(
        "temperature", F.when(F.col("humidity") < 60, F.col("temperature"))
    )
    archive = hours.where(F.col("date") <= "2024-01-25").withColumn(
        "temperature", F.col("temperature") - F.lit(1.0)
    )
    return joins.merge_feeds(forecast, archive, hours)


@query(
    "j5_city_lookup",
    o.using(
        "enriched city_ids",
        """SELECT event_id, e.province, city_id FROM enriched e
 LEFT JOIN city_ids c ON e.province = c.province""",
    ),
)
def j5(b: Binding) -> DataFrame:
    # The city goes onto the stations, so the readings are joined once.
    located = joins.with_city(b.stations, b.registry)
    return joins.enrich_left(b.readings, located).select("event_id", "province", "city_id")


# Aggregates


@query("a1_daily_rollup", o.using("daily", "SELECT * FROM daily"))
def a1(b: Binding) -> DataFrame:
    return b.daily


@query("a2_peak_hour_latest", o.using("daily", "SELECT date, station_id, peak_aqi_hour FROM daily"))
def a2(b: Binding) -> DataFrame:
    peak = rollups.peak_hour(pm25_to_aqi_sql("pm25"), "hour(timestamp)")
    grouped = b.days.groupBy("date", "station_id").agg(peak.alias("peak_aqi_hour"))
    return rollups.render_date(grouped)


@query(
    "a3_peak_hour_first",
    o.using(
        "readings",
        f"""SELECT date, station_id, -(max({{'a': aqi, 'h': -hour(timestamp)}}).h)::int AS peak_aqi_hour
 FROM (SELECT *, {o.aqi('pm25')} AS aqi FROM readings) GROUP BY date, station_id""",
    ),
)
def a3(b: Binding) -> DataFrame:
    aqi = pm25_to_aqi_sql("pm25", "null")
    peak = rollups.peak_hour(aqi, "hour(timestamp)", tie="first", empty=0)
    grouped = b.days.groupBy("date", "station_id").agg(peak.alias("peak_aqi_hour"))
    return rollups.render_date(grouped)


@query("a4_station_summary", o.using("summary", "SELECT * FROM summary"))
def a4(b: Binding) -> DataFrame:
    return b.summary


@query(
    "a5_hourly_rollup",
    o.using("windows", "SELECT * EXCLUDE (region), hour_start + INTERVAL 1 HOUR AS hour_stop FROM windows"),
)
def a5(b: Binding) -> DataFrame:
    return (
        b.windows.withColumns({"hour_start": F.col("window.start"), "hour_stop": F.col("window.end")})
        .drop("window", "region")
    )


@query(
    "a6_national_means",
    o.using(
        "summary",
        f"""SELECT {o.mean('avg_temp', 2, ties='even')} AS national_avg_temp,
 {o.mean('avg_pm25', 2, ties='even')} AS national_avg_pm25 FROM summary""",
    ),
)
def a6(b: Binding) -> DataFrame:
    return rollups.national_means(b.summary, HOW)


@query(
    "a7_region_max",
    o.using("enriched", "SELECT region, max(temperature) AS max_temp FROM enriched WHERE region IS NOT NULL GROUP BY region"),
)
def a7(b: Binding) -> DataFrame:
    # A line names its station; regions follow from the maxima, one row per station.
    lines = b.readings.select(F.concat_ws(",", "date", "station_id", "temperature", "humidity").alias("value"))
    # Event properties are lines without four fields; they must not count.
    highest = rollups.region_max_temperature(lines.union(b.events.select("props")), "station_id")
    return rollups.region_max_of_stations(highest, b.stations)


@query(
    "a8_region_sql",
    o.using(
        "enriched",
        """SELECT region, avg(temperature) AS avg_temperature, sum(no2) AS total_precipitation
 FROM enriched GROUP BY region""",
    ),
)
def a8(b: Binding) -> DataFrame:
    weather = b.readings.select(
        "station_id", F.col("temperature").alias("temp"), F.col("no2").alias("precipitation")
    )
    return rollups.region_weather(weather, b.stations)


@query("a9_last_updated", "SELECT max(ts) AS last_updated FROM events")
def a9(b: Binding) -> DataFrame:
    return rollups.last_updated(b.readings)


@query(
    "a1_daily_state",
    o.using("daily", "SELECT * FROM daily WHERE date BETWEEN '2024-01-01' AND '2024-01-30'"),
)
def a1_state(b: Binding) -> DataFrame:
    """The rolling daily view after three daily runs, each of which read the days without state only."""
    return _after_runs(b)[0]


@query(
    "a4_summary_of_states",
    o.using(
        "enriched",
        f"""SELECT station_id, province, region, {o.mean('temperature', 1)} AS avg_temp,
  {o.half_away('max(temperature)', 1)} AS max_temp, {o.mean('humidity', 1)} AS avg_humidity,
  {o.mean('pm25', 2)} AS avg_pm25, {o.mean('no2', 2)} AS avg_no2, count(*) AS record_count
 FROM enriched WHERE date BETWEEN '2024-01-01' AND '2024-01-30' GROUP BY station_id, province, region""",
    ),
)
def a4_states(b: Binding) -> DataFrame:
    """The 30-day summary after three daily runs."""
    return _after_runs(b)[1]


def _after_runs(b: Binding) -> tuple[DataFrame, DataFrame]:
    state = b.scratch("daily-state")
    for as_of in ("2024-01-29", "2024-01-30", "2024-01-31"):
        start, end = rolling_window(as_of)
        known = daily_state.known_days(b.spark, state)
        new = [day for day in daily_state.days_between(start, end) if day not in known]
        # The bounds of the new days reach the scan of the events.
        daily_state.update_state(b.spark, date_range(b.readings, min(new), max(new), "timestamp"), state, new)
    return daily_state.window_views(b.spark, state, b.stations, start, end)


@query("a10_row_count", "SELECT count(*) AS rows FROM events")
def a10(b: Binding) -> DataFrame:
    return rollups.row_count(b.readings)


_COMPLETE_SUMMARY = f"""SELECT station_id, province, region, {o.mean('temperature', 1, ties='up')} AS avg_temp,
 {o.half_up('max(temperature)', 1)} AS max_temp, {o.mean('humidity', 0, ties='up')} AS avg_humidity,
 {o.mean('pm25', 2, ties='up')} AS avg_pm25, {o.mean('no2', 2, ties='up')} AS avg_no2,
 count(temperature) AS record_count"""


@query(
    "a11_complete_summary",
    o.using("redated", f"{_COMPLETE_SUMMARY} FROM redated GROUP BY station_id, province, region"),
)
def a11(b: Binding) -> DataFrame:
    return rollups.complete_summary(_redated(b), HOW)


@query(
    "a12_complete_daily",
    o.using(
        "redated",
        f"""SELECT date, station_id, province, region, {o.mean('temperature', 1, ties='up')} AS avg_temp,
 {o.half_up('max(temperature)', 1)} AS max_temp, {o.half_up('min(temperature)', 1)} AS min_temp,
 {o.mean('humidity', 0, ties='up')} AS avg_humidity, {o.mean('pm25', 2, ties='up')} AS avg_pm25,
 {o.mean('no2', 2, ties='up')} AS avg_no2, floor(avg(aqi) + 0.5::double) AS avg_aqi,
 -(max({{'a': aqi, 'h': -slot}}).h)::int AS peak_aqi_hour, count(temperature) AS record_count
 FROM (SELECT *, {o.aqi('pm25', 'NULL')} AS aqi FROM redated) GROUP BY date, station_id, province, region""",
    ),
)
def a12(b: Binding) -> DataFrame:
    return rollups.complete_daily(_redated(b), HOW)


@query(
    "a13_share_of_max",
    o.using(
        "summary",
        """SELECT station_id, avg_pm25, avg_pm25 / max(avg_pm25) OVER () AS share
 FROM (SELECT * FROM summary ORDER BY avg_pm25 DESC NULLS LAST, station_id LIMIT 5)""",
    ),
)
def a13(b: Binding) -> DataFrame:
    listed = ranking.top_n(b.summary, "avg_pm25").select("station_id", "avg_pm25")
    return ranking.share_of_max(listed, "avg_pm25")


# Time series


def _complete(b: Binding) -> DataFrame:
    return complete.complete_days(b.region_hours)


def _redated(b: Binding) -> DataFrame:
    return complete.redate_recent(_complete(b), ANCHOR)


@query(
    "w1_latest_per_key",
    o.using(
        "readings",
        """SELECT * EXCLUDE (_n) FROM (SELECT *, row_number() OVER (PARTITION BY station_id
 ORDER BY timestamp DESC, event_id DESC) AS _n FROM readings) WHERE _n = 1""",
    ),
)
def w1(b: Binding) -> DataFrame:
    return latest.latest_rows(b.readings, ["station_id"], "timestamp", TIEBREAK)


@query(
    "w2_last_n",
    o.using(
        "readings",
        """SELECT * EXCLUDE (_n) FROM (SELECT *, row_number() OVER (PARTITION BY station_id
 ORDER BY timestamp DESC, event_id DESC) AS _n FROM readings) WHERE _n <= 30""",
    ),
)
def w2(b: Binding) -> DataFrame:
    return latest.last_n(b.readings, latest.clamp_limit(None), tiebreak=TIEBREAK)


@query(
    "w3_latest_day",
    o.using(
        "hourly",
        """SELECT h.station_id, h.timestamp, h.temperature, hour(h.timestamp)::int AS hour FROM hourly h
 JOIN (SELECT station_id, max(date) AS date FROM hourly GROUP BY station_id) d
 ON h.station_id = d.station_id AND h.date = d.date""",
    ),
)
def w3(b: Binding) -> DataFrame:
    day = projections.with_hour(latest.latest_day(b.hourly))
    return day.select("station_id", "timestamp", "temperature", "hour")


@query(
    "w4_profile_for_today",
    o.using(
        "complete",
        """SELECT station_id, province, region, temperature, humidity, pm25, no2, slot, '2026-06-02' AS date,
 TIMESTAMP '2026-06-02' + to_hours(slot) AS timestamp
 FROM (SELECT *, dense_rank() OVER (PARTITION BY station_id ORDER BY date DESC) AS _r FROM complete)
 WHERE _r = 1 AND slot <= 13""",
    ),
)
def w4(b: Binding) -> DataFrame:
    return complete.profile_for_today(_complete(b), NOW)


@query("w5_complete_days", o.using("complete", "SELECT * FROM complete"))
def w5(b: Binding) -> DataFrame:
    return _complete(b)


@query("w6_redate_recent", o.using("redated", "SELECT * FROM redated"))
def w6(b: Binding) -> DataFrame:
    return _redated(b)


@query(
    "w7_display_rank",
    o.using(
        "realtime",
        """SELECT station_id, province, aqi_index, row_number() OVER (ORDER BY aqi_index DESC NULLS LAST, station_id) AS rank
 FROM realtime""",
    ),
)
def w7(b: Binding) -> DataFrame:
    listed = b.realtime.select("station_id", "province", "aqi_index")
    return ranking.rank_by(listed, "aqi_index", "desc")


# Sorting, top-k, set operations


@query("t1_ordered_daily", o.using("daily", "SELECT date, region, province, station_id, avg_temp FROM daily"))
def t1(b: Binding) -> DataFrame:
    return b.daily.select("date", "region", "province", "station_id", "avg_temp").orderBy(
        "date", "region", "province", "station_id"
    )


@query(
    "t2_top_five",
    o.using(
        "summary",
        """(SELECT 'hottest' AS list, (row_number() OVER (ORDER BY avg_temp DESC NULLS LAST, station_id))::int AS place,
  station_id, province, avg_temp AS value FROM summary ORDER BY avg_temp DESC NULLS LAST, station_id LIMIT 5)
 UNION ALL
 (SELECT 'polluted', (row_number() OVER (ORDER BY avg_pm25 DESC NULLS LAST, station_id))::int,
  station_id, province, avg_pm25 FROM summary ORDER BY avg_pm25 DESC NULLS LAST, station_id LIMIT 5)""",
    ),
)
def t2(b: Binding) -> DataFrame:
    lists = ranking.top_lists(b.summary, {"hottest": "avg_temp", "polluted": "avg_pm25"})
    value = F.when(F.col("list") == "hottest", F.col("avg_temp")).otherwise(F.col("avg_pm25"))
    return lists.select("list", "place", "station_id", "province", value.alias("value"))


@query(
    "t4_sorted_table",
    o.using("realtime", "SELECT station_id, province, pm25 FROM realtime"),
)
def t4(b: Binding) -> DataFrame:
    return ranking.sort_rows(b.realtime.select("station_id", "province", "pm25"), "pm25", "desc")


@query(
    "t5_alerts_by_exceedance",
    o.using(
        "alerts",
        """SELECT station_id, alert_type, ratio, row_number() OVER (ORDER BY ratio DESC, station_id, alert_type) AS place
 FROM (SELECT *, value / CASE WHEN alert_type = 'Air Quality' THEN 150 ELSE 35 END AS ratio FROM alerts)""",
    ),
)
def t5(b: Binding) -> DataFrame:
    """All alerts with their place in the operator's order."""
    alerts = ranking.by_exceedance(explode_alerts(b.realtime))
    placed = ranking.rank_by(alerts, "ratio", "desc", ("station_id", "alert_type"), "place")
    return placed.select("station_id", "alert_type", "ratio", F.col("place").cast("long").alias("place"))


@query(
    "u1_union_by_name",
    o.using(
        "readings",
        """SELECT event_id, station_id, temperature, humidity, NULL::double AS pm25, NULL::double AS no2 FROM readings
 WHERE date < '2024-01-16'
 UNION ALL SELECT event_id, station_id, temperature, humidity, pm25, no2 FROM readings WHERE date >= '2024-01-16'""",
    ),
)
def u1(b: Binding) -> DataFrame:
    rows = b.readings.select("event_id", "station_id", "temperature", "humidity", "pm25", "no2", "date")
    history = rows.where(F.col("date") < "2024-01-16").drop("pm25", "no2")
    return union_readings(history, rows.where(F.col("date") >= "2024-01-16")).drop("date")
