"""Registered queries: the serving layer over views derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.driver import oracle as o
from aerolith.driver.binding import HOW, Binding, query
from aerolith.plans.serving import Serving
from aerolith.sinks.tables import write_partitioned

_REALTIME_COLUMNS = """event_id, station_id, province, region, date, timestamp, pm25, temperature, humidity, no2,
 aqi_index, aqi_alert, temp_alert"""
_SERIES = "timestamp, temperature, humidity, pm25, no2, aqi_index"
_FIRST_STATION = "(SELECT min('U' || cast(user_id AS varchar)) FROM events)"


def _first_station(b: Binding) -> str:
    return b.readings.agg(F.min("station_id")).first()[0]


@query("q1_realtime", o.using("realtime", f"SELECT {_REALTIME_COLUMNS} FROM realtime"))
def q1(b: Binding) -> DataFrame:
    return b.serving("realtime").realtime()


@query(
    "q1_realtime_of_province",
    o.using(
        "realtime",
        f"SELECT {_REALTIME_COLUMNS} FROM realtime WHERE province = (SELECT max(n_name) FROM nation)",
    ),
)
def q1_province(b: Binding) -> DataFrame:
    return b.serving("realtime").realtime(province=b.table("nation").agg(F.max("n_name")).first()[0])


@query(
    "q2_realtime_series",
    o.using(
        "hourly",
        f"""SELECT station_id, {_SERIES} FROM (SELECT *, row_number() OVER (PARTITION BY station_id
 ORDER BY timestamp DESC) AS _n FROM hourly) WHERE _n <= 30""",
    ),
)
def q2(b: Binding) -> DataFrame:
    return b.serving("hourly").realtime_series_all()


@query(
    "q2_series_of_station",
    o.using(
        "hourly",
        f"""SELECT {_SERIES} FROM hourly WHERE station_id = {_FIRST_STATION} ORDER BY timestamp DESC LIMIT 12""",
    ),
)
def q2_station(b: Binding) -> DataFrame:
    return b.serving("hourly").realtime_series(_first_station(b), 12)


@query(
    "q3_hourly",
    o.using(
        "hourly",
        f"""SELECT h.station_id, {', '.join('h.' + c.strip() for c in _SERIES.split(','))}, hour(h.timestamp)::int AS hour
 FROM hourly h JOIN (SELECT station_id, max(date) AS date FROM hourly GROUP BY station_id) d
 ON h.station_id = d.station_id AND h.date = d.date""",
    ),
)
def q3(b: Binding) -> DataFrame:
    return b.serving("hourly").hourly_all()


@query(
    "q3_hourly_of_date",
    o.using(
        "hourly",
        f"SELECT station_id, {_SERIES}, hour(timestamp)::int AS hour FROM hourly WHERE date = '2024-01-15'",
    ),
)
def q3_date(b: Binding) -> DataFrame:
    return b.serving("hourly").hourly_all("2024-01-15")


def _published_hours(b: Binding) -> Serving:
    """The hourly view as the keyed sink files it: by day."""
    path = b.scratch("hourly")
    write_partitioned(b.hourly, path, "date")
    return Serving(hourly_rows=b.spark.read.schema(b.hourly.schema).parquet(path), filed_by_day=True)


@query(
    "q3_published_hourly",
    o.using(
        "hourly",
        f"""SELECT h.station_id, {', '.join('h.' + c.strip() for c in _SERIES.split(','))}, hour(h.timestamp)::int AS hour
 FROM hourly h JOIN (SELECT station_id, max(date) AS date FROM hourly GROUP BY station_id) d
 ON h.station_id = d.station_id AND h.date = d.date""",
    ),
)
def q3_published(b: Binding) -> DataFrame:
    return _published_hours(b).hourly_all()


@query(
    "q3_published_date",
    o.using(
        "hourly",
        f"SELECT station_id, {_SERIES}, hour(timestamp)::int AS hour FROM hourly WHERE date = '2024-01-15'",
    ),
)
def q3_published_date(b: Binding) -> DataFrame:
    return _published_hours(b).hourly_all("2024-01-15")


@query(
    "q4_daily",
    o.using(
        "daily",
        """SELECT station_id, date, avg_temp, max_temp, min_temp, avg_pm25, avg_aqi, peak_aqi_hour FROM daily
 WHERE date >= '2024-01-05' AND date <= '2024-01-25'""",
    ),
)
def q4(b: Binding) -> DataFrame:
    start, end = "2024-01-05", "2024-01-25"
    return Serving(daily_rows=b.daily_between(start, end)).daily_all(start, end)


@query("q5_provinces", o.using("summary", "SELECT * FROM summary"))
def q5(b: Binding) -> DataFrame:
    return b.serving("summary").provinces()


@query(
    "q6_stats",
    o.using(
        "summary",
        f"""(SELECT 'hottest' AS section, (row_number() OVER (ORDER BY avg_temp DESC NULLS LAST, station_id))::int AS place,
  station_id, province, region, avg_temp, avg_pm25 FROM summary ORDER BY avg_temp DESC NULLS LAST, station_id LIMIT 5)
 UNION ALL
 (SELECT 'polluted', (row_number() OVER (ORDER BY avg_pm25 DESC NULLS LAST, station_id))::int,
  station_id, province, region, avg_temp, avg_pm25 FROM summary ORDER BY avg_pm25 DESC NULLS LAST, station_id LIMIT 5)
 UNION ALL
 SELECT 'national', NULL, NULL, NULL, NULL, {o.mean('avg_temp', 2, ties='even')}, {o.mean('avg_pm25', 2, ties='even')} FROM summary""",
    ),
)
def q6(b: Binding) -> DataFrame:
    return b.serving("summary").stats_table(HOW)


@query("q7_alerts", o.using("alerts", "SELECT * FROM alerts"))
def q7(b: Binding) -> DataFrame:
    return b.serving("realtime").alerts()


@query(
    "q7_air_alerts_of_province",
    o.using(
        "alerts",
        """SELECT * FROM alerts WHERE alert_type = 'Air Quality'
 AND province = (SELECT min(n_name) FROM nation)""",
    ),
)
def q7_province(b: Binding) -> DataFrame:
    province = b.table("nation").agg(F.min("n_name")).first()[0]
    return b.serving("realtime").alerts(province, "aqi")


@query("q8_compare", o.using("compare", "SELECT * FROM compare"))
def q8(b: Binding) -> DataFrame:
    return b.serving("realtime", "summary").compare_all()


@query(
    "q9_provinces_table",
    o.using(
        "realtime",
        f"""SELECT station_id, province, region, temperature AS temp, humidity, pm25 AS pm2_5, no2, aqi_index AS aqi_value,
 {o.aqi_alert('aqi_index', 'Unhealthy (SG)')} AS aqi_category, aqi_alert, temp_alert,
 aqi_alert IN ('Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous')
  OR temp_alert IN ('Extreme Heat', 'Too Cold') AS is_anomaly, timestamp,
 row_number() OVER (ORDER BY temperature ASC NULLS FIRST, station_id) AS rank
 FROM realtime WHERE lower(province) LIKE '%a%'""",
    ),
)
def q9(b: Binding) -> DataFrame:
    return b.serving("realtime").provinces_table(query=" A ", field="temp", direction="asc")


@query("q9_last_updated", o.using("realtime", "SELECT max(timestamp) AS last_updated FROM realtime"))
def q9_updated(b: Binding) -> DataFrame:
    return b.serving("realtime").last_updated()


@query(
    "q10_city_compare",
    o.using(
        "compare stations",
        f"""SELECT s.city_id, c.province AS city_name, current_temp, historical_avg_temp, temp_deviation, current_aqi,
 {o.aqi('historical_avg_pm25', 'NULL')} AS historical_avg_aqi,
 current_aqi - {o.aqi('historical_avg_pm25', 'NULL')} AS aqi_deviation
 FROM compare c JOIN stations s ON c.station_id = s.station_id""",
    ),
)
def q10_compare(b: Binding) -> DataFrame:
    return b.serving("realtime", "summary", "registry").city_compare()


@query(
    "q10_city_alerts",
    o.using(
        "alerts city_ids",
        """SELECT city_id, a.province AS city_name, CASE WHEN alert_type = 'Temperature' THEN 'Heatwave'
 WHEN level = 'Hazardous' THEN 'AQI Hazardous' ELSE 'Pollution Spike' END AS alert_type, value,
 CASE WHEN alert_type = 'Temperature' THEN 35 ELSE 150 END AS threshold_exceeded, timestamp
 FROM alerts a LEFT JOIN city_ids c ON a.province = c.province""",
    ),
)
def q10_alerts(b: Binding) -> DataFrame:
    return b.serving("realtime", "registry").city_alerts()


@query(
    "q10_compare_of_city",
    o.using(
        "compare stations",
        f"""SELECT s.city_id, c.province AS city_name, current_temp, historical_avg_temp, temp_deviation, current_aqi,
 {o.aqi('historical_avg_pm25', 'NULL')} AS historical_avg_aqi,
 current_aqi - {o.aqi('historical_avg_pm25', 'NULL')} AS aqi_deviation
 FROM compare c JOIN stations s ON c.station_id = s.station_id WHERE s.city_id = 7""",
    ),
)
def q10_compare_of_city(b: Binding) -> DataFrame:
    return b.serving("realtime", "summary", "registry").city_compare(7)


@query(
    "q10_alerts_of_city",
    o.using(
        "alerts stations city_ids",
        """SELECT city_id, a.province AS city_name, CASE WHEN alert_type = 'Temperature' THEN 'Heatwave'
 WHEN level = 'Hazardous' THEN 'AQI Hazardous' ELSE 'Pollution Spike' END AS alert_type, value,
 CASE WHEN alert_type = 'Temperature' THEN 35 ELSE 150 END AS threshold_exceeded, timestamp
 FROM alerts a LEFT JOIN city_ids c ON a.province = c.province
 WHERE a.province = (SELECT province FROM stations WHERE city_id = 7)""",
    ),
)
def q10_alerts_of_city(b: Binding) -> DataFrame:
    return b.serving("realtime", "registry").city_alerts(city_id=7)


@query(
    "q10_city_stats",
    o.using(
        "summary city_ids",
        f"""SELECT section, rank::int AS rank, city_id, city_name, temp, aqi FROM (
 (SELECT 'hottest' AS section, row_number() OVER (ORDER BY avg_temp DESC NULLS LAST, station_id) AS rank, city_id, s.province AS city_name, avg_temp AS temp, {o.aqi('avg_pm25', 'NULL')} AS aqi
  FROM summary s LEFT JOIN city_ids c ON s.province = c.province ORDER BY avg_temp DESC NULLS LAST, station_id LIMIT 5)
 UNION ALL
 (SELECT 'polluted', row_number() OVER (ORDER BY avg_pm25 DESC NULLS LAST, station_id), city_id, s.province, avg_temp, {o.aqi('avg_pm25', 'NULL')}
  FROM summary s LEFT JOIN city_ids c ON s.province = c.province ORDER BY avg_pm25 DESC NULLS LAST, station_id LIMIT 5)
 UNION ALL
 SELECT 'national', NULL, NULL, NULL, t, {o.aqi('p', 'NULL')} FROM (SELECT {o.mean('avg_temp', 2, ties='even')} AS t,
  {o.mean('avg_pm25', 2, ties='even')} AS p FROM summary))""",
    ),
)
def q10_stats(b: Binding) -> DataFrame:
    stats = b.serving("summary", "registry").city_stats(HOW)
    national = stats["national"].withColumnsRenamed(
        {"national_avg_temp": "temp", "national_avg_aqi": "aqi"}
    )
    return (
        stats["top_hottest_cities"]
        .withColumn("section", F.lit("hottest"))
        .unionByName(stats["top_polluted_cities"].withColumn("section", F.lit("polluted")))
        .unionByName(national.withColumn("section", F.lit("national")), allowMissingColumns=True)
    )


@query(
    "q11_city_cards",
    o.using(
        "realtime stations",
        f"""SELECT city_id, s.province AS city_name, temperature AS temp, humidity, pm25 AS pm2_5, aqi_index AS aqi_value,
 {o.aqi_alert('aqi_index', 'Unhealthy (SG)')} AS aqi_category,
 aqi_alert IN ('Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous')
  OR temp_alert IN ('Extreme Heat', 'Too Cold') AS is_anomaly, timestamp
 FROM realtime r JOIN stations s ON r.station_id = s.station_id""",
    ),
)
def q11(b: Binding) -> DataFrame:
    return b.serving("realtime", "registry").city_cards()


def many_readings(b: Binding) -> Serving:
    """Serving over all rated readings, as when the live view keeps every reading."""
    return Serving(realtime_rows=b.rated.drop("event_type"), tiebreak=("event_id",))


@query(
    "q1_realtime_of_history",
    o.using("realtime", f"SELECT {_REALTIME_COLUMNS} FROM realtime"),
)
def q1_history(b: Binding) -> DataFrame:
    return many_readings(b).realtime()
