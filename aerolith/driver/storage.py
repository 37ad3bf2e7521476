"""Registered queries: sources and sinks, written and read back in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.driver import oracle as o
from aerolith.driver.binding import AS_OF, MID_MONTH, Binding, query, without_zone
from aerolith.operators import filters, projections
from aerolith.operators.joins import enrich_left
from aerolith.plans import views
from aerolith.sinks import keyed, tables
from aerolith.sources import lake, messages, registry

_READING = "date, timestamp, station_id, pm25, temperature, humidity, no2"


def _feed(b: Binding) -> DataFrame:
    return b.readings.select(*schemas.READING.names)


def _as_stored(b: Binding) -> DataFrame:
    """Readings with instants, as the lake's schema has them."""
    return _feed(b).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _land(b: Binding, rows: DataFrame | None = None) -> str:
    path = b.scratch("lake")
    tables.write_partitioned(_as_stored(b) if rows is None else rows, path, "date")
    return path


# Sources


@query("s1_scan_history_csv", o.using("readings", f"SELECT {_READING} FROM readings"))
def s1(b: Binding) -> DataFrame:
    path = b.scratch("history")
    tables.export_station_csv(b.readings, path)
    return without_zone(lake.scan_history_csv(b.spark, path))


@query("s2_scan_stations", o.using("stations", "SELECT station_id, province, region FROM stations"))
def s2(b: Binding) -> DataFrame:
    path = b.scratch("stations")
    padded = b.stations.select(
        *[F.concat(F.lit("  "), c, F.lit(" ")).alias(c) for c in schemas.STATION.names]
    )
    padded.write.csv(path, header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return registry.scan_stations(b.spark, path)


@query(
    "s3_scan_lake",
    o.using("readings", f"SELECT {_READING} FROM readings WHERE date BETWEEN '2024-01-08' AND '2024-01-21'"),
)
def s3(b: Binding) -> DataFrame:
    return without_zone(lake.scan_lake(b.spark, _land(b), "2024-01-08", "2024-01-21"))


@query(
    "s4_rolling_window",
    o.using(
        "readings",
        """SELECT event_id, date, '2023-12-22' AS window_start, '2024-01-20' AS window_end FROM readings
 WHERE date BETWEEN '2023-12-22' AND '2024-01-20'""",
    ),
)
def s4(b: Binding) -> DataFrame:
    start, end = filters.rolling_window("2024-01-21")
    inside = filters.date_range(b.readings, start, end, column="timestamp")
    return inside.select(
        "event_id", "date", F.lit(start).alias("window_start"), F.lit(end).alias("window_end")
    )


@query(
    "s5_load_master",
    o.using(
        "readings",
        f"""SELECT {_READING} FROM readings WHERE date < '{MID_MONTH}'
 UNION ALL SELECT {_READING} FROM readings WHERE date >= '{MID_MONTH}' AND date BETWEEN '2024-01-01' AND '2024-01-30'""",
    ),
)
def s5(b: Binding) -> DataFrame:
    history = b.scratch("history")
    tables.export_station_csv(b.readings.where(F.col("date") < MID_MONTH), history)
    landed = _land(b, _as_stored(b).where(F.col("date") >= MID_MONTH))
    start, end = filters.rolling_window(AS_OF)
    return without_zone(lake.load_master(b.spark, history, landed, None, start, end))


@query(
    "s6_read_reading_stream",
    o.using("readings", f"SELECT {_READING} FROM readings"),
)
def s6(b: Binding) -> DataFrame:
    feed, out, checkpoint = b.scratch("feed"), b.scratch("lake"), b.scratch("checkpoint")
    tables.to_message_json(_feed(b)).write.text(feed)
    decoded = messages.decode_readings(messages.file_messages(b.spark, feed))
    stream = decoded.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    stream.trigger(availableNow=True).start(out).awaitTermination()
    return without_zone(b.spark.read.schema(schemas.READING).parquet(out))


@query(
    "s7_decode_readings",
    o.using(
        "readings",
        f"""SELECT {_READING} FROM readings
 UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM pages""",
    ),
)
def s7(b: Binding) -> DataFrame:
    # Web pages are text that is no JSON: each must give one row of nulls.
    text = tables.to_message_json(_feed(b)).union(b.table("pages").select("html"))
    return without_zone(messages.decode_readings(text))


@query(
    "s7_message_outcomes",
    """SELECT outcome, count(*) AS messages FROM (
 SELECT CASE event_type WHEN 'error' THEN 'broken' WHEN 'view' THEN 'missing' WHEN 'click' THEN 'null'
  WHEN 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'broken' ELSE 'reading' END ELSE 'reading' END AS outcome FROM events
 UNION ALL SELECT 'broken' FROM pages) GROUP BY outcome""",
)
def s7_outcomes(b: Binding) -> DataFrame:
    """A feed in which errors are cut off, views lack the station, clicks have it null, and some signups a word for a number."""
    kind, whole = F.col("event_type"), tables.to_message_json(_feed(b)).columns[0]
    fields = [F.col(c).cast("string").alias(c) if c in ("date", "timestamp") else F.col(c) for c in schemas.READING.names]
    text = F.to_json(F.struct(*fields))
    station = F.concat(F.lit('"station_id":"'), "station_id", F.lit('"'))
    number = F.concat(F.lit('"no2":'), F.col("no2").cast("string"))
    changed = (
        F.when(kind == "error", F.substring(text, 1, 40))
        .when(kind == "view", F.replace(text, F.concat(station, F.lit(",")), F.lit("")))
        .when(kind == "click", F.replace(text, station, F.lit('"station_id":null')))
        .when((kind == "signup") & (F.col("event_id") % 2 == 0), F.replace(text, number, F.lit('"no2":"much"')))
        .otherwise(text)
    )
    feed = b.readings.select(changed.alias(whole)).union(b.table("pages").select("html"))
    return messages.message_outcomes(feed).groupBy("outcome").agg(F.count("*").alias("messages"))


_PAYLOAD_GAPS = {"error": "pm2_5", "view": "no2", "click": "temp_c"}


@query(
    "s8_flatten_observation",
    o.using(
        "readings",
        """SELECT event_id, station_id, CASE WHEN event_type = 'error' THEN 0.0::double ELSE pm25 END AS pm25,
 temperature, humidity, CASE WHEN event_type = 'view' THEN 0.0::double ELSE no2 END AS no2
 FROM readings WHERE event_type <> 'click'""",
    ),
)
def s8(b: Binding) -> DataFrame:
    def unless(event_type: str, column: str) -> Column:
        return F.when(F.col("event_type") != event_type, F.col(column))

    # Null fields are left out of the JSON text, so each event type lacks one field.
    air = F.struct(unless("error", "pm25").alias("pm2_5"), unless("view", "no2").alias("no2"))
    current = F.struct(
        unless("click", "temperature").alias("temp_c"), "humidity", air.alias("air_quality")
    )
    payloads = b.readings.select(
        "event_id", "station_id", F.to_json(F.struct(current.alias("current"))).alias("payload")
    )
    return messages.flatten_observation(payloads)


@query(
    "s9_explode_hourly_arrays",
    o.using(
        "station_hours",
        """SELECT station_id, strftime(timestamp, '%Y-%m-%dT%H:%M') AS time, temperature, humidity FROM station_hours""",
    ),
)
def s9(b: Binding) -> DataFrame:
    slot = F.struct(
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm").alias("time"), "temperature", "humidity"
    )
    # One payload per station and day: at most 24 slots.
    packed = b.station_hours.groupBy("station_id", "date").agg(
        F.array_sort(F.collect_list(slot)).alias("s")
    )
    payload = F.struct(
        F.col("s.time").alias("time"),
        F.col("s.temperature").alias("temperature_2m"),
        F.col("s.humidity").alias("relative_humidity_2m"),
    )
    payloads = packed.select("station_id", payload.alias("payload"))
    return messages.explode_hourly(payloads, "payload", messages.WEATHER_NAMES)


_REGISTERED = ", ".join(
    f"({101 + n}, '{station}', '{province}', '{region}', {lat}::double, {lon}::double)"
    for n, (station, province, region, lat, lon) in enumerate(
        line.split(",") for line in registry._STATIONS.split("\n")[1:-1]
    )
)


@query(
    "s10_station_registry",
    o.using(
        "readings",
        f"""SELECT event_id, s.station_id, city_id, province, region, latitude, longitude, pm25
 FROM readings r JOIN (VALUES {_REGISTERED}) AS s(city_id, station_id, province, region, latitude, longitude)
 ON 101 + event_id % 40 = s.city_id""",
    ),
)
def s10(b: Binding) -> DataFrame:
    """Readings that name a city: the registry's 34 stations are found, other cities are not."""
    cities = b.readings.withColumn("city_id", (F.lit(101) + F.col("event_id") % 40).cast("int")).drop("station_id")
    found = cities.join(registry.station_registry(b.spark), "city_id")
    return found.select("event_id", "station_id", "city_id", "province", "region", "latitude", "longitude", "pm25")


@query(
    "s11_view_scan",
    o.using(
        "realtime hourly daily summary",
        """SELECT 'realtime' AS view, station_id, count(*) AS rows, max(pm25) AS highest FROM realtime GROUP BY station_id
 UNION ALL SELECT 'hourly', station_id, count(*), max(avg_pm25) FROM hourly GROUP BY station_id
 UNION ALL SELECT 'daily', station_id, count(*), max(avg_pm25) FROM daily GROUP BY station_id
 UNION ALL SELECT 'summary', station_id, count(*), max(avg_pm25) FROM summary GROUP BY station_id""",
    ),
)
def s11(b: Binding) -> DataFrame:
    root = b.scratch("views")
    seen = None
    for name in schemas.VIEWS:
        tables.publish_view(getattr(b, name), root, name)
        highest = F.max("pm25" if name == "realtime" else "avg_pm25").alias("highest")
        part = (
            tables.scan_view(b.spark, root, name)
            .groupBy(F.lit(name).alias("view"), "station_id")
            .agg(F.count("*").alias("rows"), highest)
        )
        seen = part if seen is None else seen.union(part)
    return seen


@query(
    "s12_parse_delimited_message",
    """SELECT epoch_us(ts) // 1000 AS time, user_id AS id, 1.0::double AS count, value + 5.0::double AS high,
 value - 5.0::double AS low, value AS vwap FROM events""",
)
def s12(b: Binding) -> DataFrame:
    v = F.col("value")
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    fields = [millis, F.col("user_id"), F.lit("1.0"), F.lit("0"), v + 5, v - 5, F.lit("0"), F.lit("0"), v]
    text = F.concat_ws(", ", *[f.cast("string") for f in fields])
    return messages.parse_delimited(b.events.select(text.alias("value")))


# Sinks


@query(
    "k2_write_enriched_lake",
    o.using(
        "enriched",
        f"""SELECT event_id, station_id, province, region, date, timestamp,
 {o.half_up('temperature + 0.05::double * humidity', 1)} AS heat_index,
 CASE WHEN pm25 > 150 THEN 'Hazardous' WHEN temperature > 35 THEN 'Extreme Heat' ELSE 'Normal' END AS weather_condition
 FROM enriched""",
    ),
)
def k2(b: Binding) -> DataFrame:
    path = b.scratch("enriched")
    conditions = projections.derive_conditions(enrich_left(b.readings, b.stations))
    kept = conditions.select(
        "event_id",
        "station_id",
        "province",
        "region",
        "date",
        "timestamp",
        "heat_index",
        "weather_condition",
    )
    tables.write_enriched_lake(kept, path)
    return b.spark.read.schema(kept.schema).parquet(path)


@query("k3_publish_batch_view", o.using("daily", "SELECT * FROM daily"))
def k3(b: Binding) -> DataFrame:
    root = b.scratch("views")
    tables.publish_view(b.summary, root, "daily")
    tables.publish_view(b.daily, root, "daily")
    return tables.scan_view(b.spark, root, "daily")


@query(
    "k4_upsert_latest",
    o.using(
        "realtime",
        """SELECT station_id, province, region, date, timestamp, pm25, temperature, humidity, no2, aqi_index, aqi_alert,
 temp_alert FROM realtime""",
    ),
)
def k4(b: Binding) -> DataFrame:
    table = keyed.snapshot_table(b.scratch("realtime"), schemas.REALTIME_VIEW)
    rated = keyed.with_slot(b.rated.withColumn("timestamp", F.col("timestamp").cast("timestamp")))
    # The newer half first: older rows that come later must not win.
    table.upsert(rated.where(F.col("date") >= MID_MONTH), 0)
    table.upsert(rated.where(F.col("date") < MID_MONTH), 1)
    return without_zone(table.read(b.spark).drop(keyed.SNAPSHOT_SLOT))


_HOURLY_COLUMNS = "_id, station_id, province, region, date, timestamp, hour_end, avg_pm25, avg_temp, avg_aqi, max_aqi"


def _hour_rows(rows: DataFrame) -> DataFrame:
    zoned = {c: F.col(c).cast("timestamp") for c in ("timestamp", "hour_end")}
    return rows.withColumns(zoned)


@query("k5_upsert_hourly", o.using("hourly", f"SELECT {_HOURLY_COLUMNS} FROM hourly"))
def k5(b: Binding) -> DataFrame:
    table = keyed.series_table(b.scratch("hourly"), schemas.HOURLY_VIEW)
    # Each hour is emitted while it runs and again when it is whole.
    running = b.readings.where(F.minute("timestamp") < 30)
    from_running = views.hourly_view(running, b.stations, "fixed")
    table.upsert(_hour_rows(from_running), 0)
    table.upsert(_hour_rows(b.hourly), 1)
    return without_zone(table.read(b.spark)).select(*_HOURLY_COLUMNS.split(", "))


@query(
    "k6_to_message_json",
    o.using(
        "readings",
        """SELECT '{"date":"' || date || '","timestamp":"' || timestamp::varchar || '","station_id":"' || station_id
 || '","pm25":' || pm25::varchar || ',"temperature":' || temperature::varchar || ',"humidity":' || humidity::varchar
 || ',"no2":' || no2::varchar || '}' AS value FROM readings""",
    ),
)
def k6(b: Binding) -> DataFrame:
    return tables.to_message_json(_feed(b))


@query(
    "k7_export_station_csv",
    o.using(
        "readings",
        """SELECT station_id, timestamp::varchar AS time, temperature::varchar AS temp, humidity::varchar AS rhum,
 CASE WHEN event_type <> 'error' THEN pm25::varchar END AS pm25, no2::varchar AS no2 FROM readings""",
    ),
)
def k7(b: Binding) -> DataFrame:
    path = b.scratch("export")
    gappy = F.when(F.col("event_type") != "error", F.col("pm25"))
    tables.export_station_csv(b.readings.withColumn("pm25", gappy), path)
    return b.spark.read.csv(path, header=True)


@query(
    "k8_upsert_by_id",
    o.using(
        "hourly",
        f"""SELECT _id, station_id, date, timestamp, CASE WHEN date = '2024-01-30' THEN 0.0::double ELSE pm25 END AS pm25
 FROM hourly""",
    ),
)
def k8(b: Binding) -> DataFrame:
    table = keyed.series_table(b.scratch("hourly"), schemas.HOURLY_VIEW)
    live = _hour_rows(b.hourly)
    table.upsert(live, 0)
    # A backfill of one day beside the live rows: its rows are replaced, the others stay.
    table.upsert(live.where(F.col("date") == "2024-01-30").withColumn("pm25", F.lit(0.0)), 1)
    return without_zone(table.read(b.spark)).select("_id", "station_id", "date", "timestamp", "pm25")


@query("k10_drop_views", o.using("summary", "SELECT 'summary' AS view, station_id, record_count FROM summary"))
def k10(b: Binding) -> DataFrame:
    root = b.scratch("views")
    tables.publish_view(b.summary, root, "summary")
    tables.publish_view(b.summary.select("station_id"), root, "realtime")
    dropped = tables.drop_views(b.spark, root, "realtime", "hourly")
    assert dropped == ["realtime"]
    left = tables.scan_view(b.spark, root, "summary")
    return left.select(F.lit("summary").alias("view"), "station_id", "record_count")


@query("k12_write_modes", o.using("readings", "SELECT event_id, station_id, pm25 FROM readings"))
def k12(b: Binding) -> DataFrame:
    path = b.scratch("processed")
    rows = b.readings.select("event_id", "station_id", "pm25", "date")
    early = rows.where(F.col("date") < MID_MONTH).drop("date")
    tables.write_processed(rows.drop("date"), path)
    tables.write_processed(early, path, "overwrite")
    tables.write_processed(rows.where(F.col("date") >= MID_MONTH).drop("date"), path, "append")
    return b.spark.read.parquet(path)
