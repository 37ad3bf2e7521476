"""SQL text shared by the oracles. Written apart from the operators, for another engine."""

from __future__ import annotations


def aqi(x: str, null: str = "0") -> str:
    return f"""CASE WHEN {x} IS NULL THEN {null}
 WHEN {x} <= 12.0::double THEN floor((50.0::double/12.0::double)*{x}+0.5::double)::int
 WHEN {x} <= 35.4::double THEN floor((49.0::double/(35.4::double-12.1::double))*({x}-12.1::double)+51.0::double+0.5::double)::int
 WHEN {x} <= 55.4::double THEN floor((49.0::double/(55.4::double-35.5::double))*({x}-35.5::double)+101.0::double+0.5::double)::int
 WHEN {x} <= 150.4::double THEN floor((49.0::double/(150.4::double-55.5::double))*({x}-55.5::double)+151.0::double+0.5::double)::int
 WHEN {x} <= 250.4::double THEN floor((99.0::double/(250.4::double-150.5::double))*({x}-150.5::double)+201.0::double+0.5::double)::int
 WHEN {x} <= 350.4::double THEN floor((99.0::double/(350.4::double-250.5::double))*({x}-250.5::double)+301.0::double+0.5::double)::int
 WHEN {x} <= 500.4::double THEN floor((99.0::double/(500.4::double-350.5::double))*({x}-350.5::double)+401.0::double+0.5::double)::int
 ELSE 500 END"""


def aqi_alert(x: str, third: str = "Unhealthy for Sensitive Groups") -> str:
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= 50 THEN 'Good' WHEN {x} <= 100 THEN 'Moderate'
 WHEN {x} <= 150 THEN '{third}' WHEN {x} <= 200 THEN 'Unhealthy' WHEN {x} <= 300 THEN 'Very Unhealthy'
 ELSE 'Hazardous' END"""


def temp_alert(x: str) -> str:
    return f"""CASE WHEN {x} IS NULL THEN NULL WHEN {x} < 10 THEN 'Too Cold' WHEN {x} <= 35 THEN 'Normal'
 WHEN {x} <= 40 THEN 'Hot' ELSE 'Extreme Heat' END"""


def half_up(x: str, digits: int) -> str:
    scale = f"{10**digits}.0::double"
    return f"floor(({x})*{scale}+0.5::double)/{scale}"


def half_away(x: str, digits: int) -> str:
    return f"round(({x})::varchar::decimal(38,20),{digits})::double"


def mean(x: str, digits: int, scale: int = 6, ties: str = "away") -> str:
    """Rounded mean from whole 10**-scale units."""
    total = f"(sum(cast(round(({x})*{10**scale}) AS bigint))::bigint)"
    n, step = f"(count({x}))", 10 ** (scale - digits)
    unit = f"({step}*{n})"
    if ties == "away":
        whole = f"sign({total})*((2*abs({total})+{unit})//nullif(2*{unit},0))"
    elif ties == "up":
        num, den = f"(2*{total}+{unit})", f"nullif(2*{unit},0)"
        whole = f"({num}-((({num}%{den})+{den})%{den}))//{den}"
    else:
        below = f"(({total}-((({total}%nullif({unit},0))+{unit})%nullif({unit},0)))//nullif({unit},0))"
        rest = f"(2*({total}-{below}*{unit}))"
        whole = (
            f"{below}+CASE WHEN {rest}>{unit} THEN 1 WHEN {rest}={unit} THEN (({below}%2)+2)%2 ELSE 0 END"
        )
    return f"({whole})::double/{10**digits}::double"


READINGS = """readings AS (
 SELECT event_id, event_type, 'U' || cast(user_id AS varchar) AS station_id, ts AS timestamp,
  strftime(ts, '%Y-%m-%d') AS date, value AS pm25,
  json_extract_string(props, '$.k')::int*0.5::double - 5.0::double AS temperature,
  json_extract_string(props, '$.k')::double AS humidity,
  (event_id % 100)*0.5::double AS no2
 FROM events)"""

STATIONS = """stations AS (
 SELECT 'U' || cast(c_custkey AS varchar) AS station_id, c_custkey AS city_id, n_name AS province, r_name AS region
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

ENRICHED = """enriched AS (
 SELECT r.*, s.province, s.region FROM readings r LEFT JOIN stations s ON r.station_id = s.station_id)"""

RATED = f"""rated AS (
 SELECT *, {aqi_alert('aqi_index')} AS aqi_alert, {temp_alert('temperature')} AS temp_alert
 FROM (SELECT r.*, s.province, s.region, {aqi('r.pm25')} AS aqi_index
  FROM readings r JOIN stations s ON r.station_id = s.station_id))"""

LABELLED = f"""labelled AS (
 SELECT *, {aqi_alert('aqi_index')} AS aqi_alert, {temp_alert('temperature')} AS temp_alert
 FROM (SELECT *, {aqi('pm25')} AS aqi_index FROM readings))"""

REALTIME = """realtime AS (
 SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY timestamp DESC, event_id DESC) AS _n
  FROM rated) WHERE _n = 1)"""

DAILY = f"""daily AS (
 SELECT date, station_id, province, region, {mean('temperature', 1)} AS avg_temp,
  {half_away('max(temperature)', 1)} AS max_temp, {half_away('min(temperature)', 1)} AS min_temp,
  {mean('humidity', 1)} AS avg_humidity, {mean('pm25', 2)} AS avg_pm25, {mean('no2', 2)} AS avg_no2,
  {mean('aqi', 0, scale=0)} AS avg_aqi, max({{'a': aqi, 'h': hour(timestamp)}}).h::int AS peak_aqi_hour,
  count(*) AS record_count
 FROM (SELECT *, {aqi('pm25')} AS aqi FROM enriched) GROUP BY date, station_id, province, region)"""

SUMMARY = f"""summary AS (
 SELECT station_id, province, region, {mean('temperature', 1)} AS avg_temp,
  {half_away('max(temperature)', 1)} AS max_temp, {mean('humidity', 1)} AS avg_humidity,
  {mean('pm25', 2)} AS avg_pm25, {mean('no2', 2)} AS avg_no2, count(*) AS record_count
 FROM enriched GROUP BY station_id, province, region)"""


def _spread(x: str, name: str, digits: int) -> str:
    return (
        f"{mean(x, digits)} AS avg_{name}, {half_away(f'max({x})', digits)} AS max_{name}, "
        f"{half_away(f'min({x})', digits)} AS min_{name}"
    )


HOUR_MEASURES = f"""{_spread('pm25', 'pm25', 2)}, {_spread('temperature', 'temp', 1)},
  {_spread('humidity', 'humidity', 1)}, {mean('no2', 2)} AS avg_no2,
  {half_away('avg(aqi_index)', 0)} AS avg_aqi, max(aqi_index) AS max_aqi"""

WINDOWS = f"""windows AS (
 SELECT station_id, province, region, date_trunc('hour', timestamp) AS hour_start, {HOUR_MEASURES}
 FROM rated GROUP BY station_id, province, region, date_trunc('hour', timestamp))"""

HOURLY = f"""hourly AS (
 SELECT * EXCLUDE (hour_start), hour_start + INTERVAL 7 HOUR AS timestamp, hour_start + INTERVAL 8 HOUR AS hour_end,
  strftime(hour_start + INTERVAL 7 HOUR, '%Y-%m-%d') AS date,
  avg_temp AS temperature, avg_humidity AS humidity, avg_pm25 AS pm25, avg_no2 AS no2, avg_aqi AS aqi_index,
  {aqi_alert('avg_aqi')} AS aqi_alert, {temp_alert('avg_temp')} AS temp_alert,
  station_id || '_' || strftime(hour_start + INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S') AS _id
 FROM windows)"""

STATION_HOURS = f"""station_hours AS (
 SELECT station_id, strftime(hour_start, '%Y-%m-%d') AS date, hour_start AS timestamp, pm25, temperature, humidity, no2
 FROM (SELECT station_id, date_trunc('hour', timestamp) AS hour_start, {mean('pm25', 2)} AS pm25,
  {mean('temperature', 1)} AS temperature, {mean('humidity', 1)} AS humidity, {mean('no2', 2)} AS no2
  FROM readings GROUP BY station_id, date_trunc('hour', timestamp)))"""

REGION_HOURS = f"""region_hours AS (
 SELECT region AS station_id, region AS province, region, strftime(hour_start, '%Y-%m-%d') AS date,
  hour_start AS timestamp, pm25, temperature, humidity, no2
 FROM (SELECT region, date_trunc('hour', timestamp) AS hour_start, {mean('pm25', 2)} AS pm25,
  {mean('temperature', 1)} AS temperature, {mean('humidity', 1)} AS humidity, {mean('no2', 2)} AS no2
  FROM rated GROUP BY region, date_trunc('hour', timestamp)))"""

COMPLETE = """complete AS (
 SELECT * EXCLUDE (_good) FROM (
  SELECT *, count(*) FILTER (temperature IS NOT NULL AND pm25 IS NOT NULL) OVER (PARTITION BY station_id, date) AS _good
  FROM (SELECT *, (row_number() OVER (PARTITION BY station_id, date ORDER BY timestamp) - 1)::int AS slot FROM region_hours)
  WHERE slot < 24)
 WHERE _good = 24)"""

REDATED = """redated AS (
 SELECT station_id, province, region, temperature, humidity, pm25, no2, slot,
  strftime(DATE '2026-06-01' - (_rank - 1)::int, '%Y-%m-%d') AS date,
  (DATE '2026-06-01' - (_rank - 1)::int)::timestamp + to_hours(slot) AS timestamp
 FROM (SELECT *, dense_rank() OVER (PARTITION BY station_id ORDER BY date DESC) AS _rank FROM complete)
 WHERE _rank <= 30)"""

ALERTS = """alerts AS (
 SELECT station_id, province, region, 'Air Quality' AS alert_type, aqi_alert AS level, aqi_index::double AS value, timestamp
 FROM realtime WHERE aqi_alert IN ('Unhealthy for Sensitive Groups', 'Unhealthy', 'Very Unhealthy', 'Hazardous')
 UNION ALL
 SELECT station_id, province, region, 'Temperature', temp_alert, temperature, timestamp
 FROM realtime WHERE temp_alert IN ('Hot', 'Extreme Heat', 'Too Cold'))"""

COMPARE = f"""compare AS (
 SELECT r.station_id, r.province, r.region, r.temperature AS current_temp, s.avg_temp AS historical_avg_temp,
  r.pm25 AS current_pm25, s.avg_pm25 AS historical_avg_pm25, r.aqi_index AS current_aqi,
  {half_up('r.temperature - s.avg_temp', 1)} AS temp_deviation,
  {half_up('r.pm25 - s.avg_pm25', 2)} AS pm25_deviation
 FROM realtime r JOIN summary s ON r.station_id = s.station_id)"""

CITY_IDS = "city_ids AS (SELECT province, min(city_id) AS city_id FROM stations GROUP BY province)"

_PARTS = {
    "readings": (READINGS, ()),
    "stations": (STATIONS, ()),
    "enriched": (ENRICHED, ("readings", "stations")),
    "rated": (RATED, ("readings", "stations")),
    "labelled": (LABELLED, ("readings",)),
    "realtime": (REALTIME, ("rated",)),
    "daily": (DAILY, ("enriched",)),
    "summary": (SUMMARY, ("enriched",)),
    "windows": (WINDOWS, ("rated",)),
    "hourly": (HOURLY, ("windows",)),
    "station_hours": (STATION_HOURS, ("readings",)),
    "region_hours": (REGION_HOURS, ("rated",)),
    "complete": (COMPLETE, ("region_hours",)),
    "redated": (REDATED, ("complete",)),
    "alerts": (ALERTS, ("realtime",)),
    "compare": (COMPARE, ("realtime", "summary")),
    "city_ids": (CITY_IDS, ("stations",)),
}


def using(parts: str, body: str) -> str:
    """``body`` behind the common tables it names, and those they need."""
    ordered: list[str] = []

    def add(part: str) -> None:
        for needed in _PARTS[part][1]:
            add(needed)
        if part not in ordered:
            ordered.append(part)

    for part in parts.split():
        add(part)
    return f"WITH {', '.join(_PARTS[p][0] for p in ordered)}\n{body}"
