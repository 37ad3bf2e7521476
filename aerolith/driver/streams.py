"""Registered queries: structured streaming over the driver's events, run until all is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.driver import oracle as o
from aerolith.driver.binding import HOW, MID_MONTH, Binding, query, without_zone
from aerolith.operators import projections
from aerolith.sinks import keyed
from aerolith.streaming import speed

_RATED = "event_id, station_id, province, region, timestamp, pm25, aqi_index, aqi_alert, temp_alert"
_WINDOW = "station_id, province, region, hour_start, avg_pm25, avg_temp, max_aqi"
_KEYS = ("station_id", "province", "region")
_HALF_SQL = "(event_id % 3 = 0)::int"


def _half() -> Column:
    return (F.col("event_id") % 3 == 0).cast("int")



def _rated(b: Binding, stream: DataFrame | None = None) -> DataFrame:
    return speed.rated_stream(b.event_stream if stream is None else stream, b.stations)


def _windows(rated: DataFrame) -> DataFrame:
    return speed.hourly_stream(rated, keys=_KEYS, how=HOW)


def _series(b: Binding) -> keyed.KeyedTable:
    return keyed.series_table(b.scratch("hourly"), schemas.HOURLY_VIEW)


def _hour_starts(b: Binding, table: keyed.KeyedTable) -> DataFrame:
    rows = without_zone(table.read(b.spark))
    shifted = F.col("timestamp") - F.expr("INTERVAL '7' HOUR")
    return rows.withColumn("hour_start", shifted).select(*_WINDOW.split(", "))


def _two_halves(b: Binding) -> tuple[str, callable]:
    """A source folder holding the first half of the month, and a call that adds the second."""
    path = b.scratch("source")
    early = F.col("ts") < F.lit(MID_MONTH).cast("timestamp_ntz")
    b.events.where(early).write.parquet(path)
    return path, lambda: b.events.where(~early).write.mode("append").parquet(path)


@query(
    "k1_land_stream",
    o.using("readings", "SELECT date, timestamp, station_id, pm25, temperature, humidity, no2 FROM readings"),
)
def k1(b: Binding) -> DataFrame:
    path = b.scratch("lake")
    feed = b.event_stream.select(*schemas.READING.names)
    speed.drain(speed.land_stream(feed, path, b.scratch("checkpoint"), interval=None))
    return without_zone(b.spark.read.schema(schemas.READING).parquet(path))


@query(
    "st1_watermark",
    o.using(
        "windows",
        f"""SELECT {_WINDOW} FROM windows
 WHERE hour_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""",
    ),
)
def st1(b: Binding) -> DataFrame:
    """Append output holds an hour back until the watermark passes its end."""
    out = b.scratch("closed")
    with b.stateful():
        closed = _windows(_rated(b)).withColumn("hour_start", F.col("window.start")).drop("window")
        writer = closed.writeStream.format("parquet").outputMode("append")
        writer = writer.option("checkpointLocation", b.scratch("checkpoint"))
        speed.drain(writer.trigger(availableNow=True).start(out))
    return without_zone(b.spark.read.parquet(out)).select(*_WINDOW.split(", "))


@query("st2_hourly_stream", o.using("windows", f"SELECT {_WINDOW} FROM windows"))
def st2(b: Binding) -> DataFrame:
    table = _series(b)
    with b.stateful():
        hourly = speed.hourly_rows(_windows(_rated(b)))
        speed.drain(speed.start_hourly(hourly, table, b.scratch("checkpoint")))
    return _hour_starts(b, table)


@query(
    "st3_update_output",
    o.using(
        "rated windows",
        f"""SELECT station_id, hour_start, n AS batch, max(aqi_index) AS max_aqi, count(*) AS rows
 FROM (SELECT station_id, date_trunc('hour', timestamp) AS hour_start, aqi_index, {_HALF_SQL} AS half FROM rated) r
 JOIN (VALUES (0), (1)) AS b(n) ON half <= n
 GROUP BY station_id, hour_start, n HAVING max(half) = n""",
    ),
)
def st3(b: Binding) -> DataFrame:
    """Every emission of every hour: an hour that gets rows in both triggers is emitted twice, the second time whole."""
    out, source = b.scratch("emitted"), b.scratch("source")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/trigger={batch_id}")

    # Both triggers bring rows of every hour, within the watermark of the days before.
    for half in (0, 1):
        b.events.where(_half() == half).coalesce(1).write.mode("append").parquet(source)
        with b.stateful():
            rated = _rated(b, b.stream_of(source))
            # No watermark: hours of the whole month come again in the second trigger.
            windows = rated.groupBy("station_id", F.window("timestamp", "1 hour")["start"].alias("hour_start"))
            counted = windows.agg(F.max("aqi_index").alias("max_aqi"), F.count("*").alias("rows"))
            speed.drain(speed.each_batch(counted, keep, f"{source}-checkpoint", "update", None))
    emitted = without_zone(b.spark.read.parquet(out))
    return emitted.select("station_id", "hour_start", F.col("trigger").cast("int").alias("batch"), "max_aqi", "rows")


@query(
    "a10_stream_counts",
    f"""SELECT {_HALF_SQL} AS batch, count(*) AS rows,
 count(*) FILTER (event_type NOT IN ('error', 'click')) AS accepted, count(*) FILTER (event_type IN ('error', 'click')) AS rejected
 FROM events GROUP BY 1""",
)
def a10_stream(b: Binding) -> DataFrame:
    """How many readings of each trigger were of known and of unknown stations, as the running query counted them."""
    source, checkpoint = b.scratch("source"), b.scratch("checkpoint")
    table = keyed.snapshot_table(b.scratch("realtime"), schemas.REALTIME_VIEW)
    counts = []
    for half in (0, 1):
        b.events.where(_half() == half).write.mode("append").parquet(source)
        counted = speed.counted_stream(b.stream_of(source, strange=True), b.stations)
        running = speed.start_latest(counted, table, checkpoint)
        speed.drain(running)
        counts += speed.batch_counts(running)
    # One row per trigger.
    return b.spark.createDataFrame(
        [tuple(c[n] for n in ("batch", "rows", "accepted", "rejected")) for c in counts],
        "batch int, rows long, accepted long, rejected long",
    )


@query("st4_append_output", o.using("rated", f"SELECT {_RATED} FROM rated"))
def st4(b: Binding) -> DataFrame:
    out = b.scratch("rated")
    writer = _rated(b).select(*_RATED.split(", ")).writeStream.format("parquet").outputMode("append")
    writer = writer.option("checkpointLocation", b.scratch("checkpoint"))
    speed.drain(writer.trigger(availableNow=True).start(out))
    return without_zone(b.spark.read.parquet(out))


@query("st5_foreach_batch", o.using("readings", "SELECT event_id, station_id, pm25 FROM readings"))
def st5(b: Binding) -> DataFrame:
    out = b.scratch("batches")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    rows = b.event_stream.select("event_id", "station_id", "pm25")
    speed.drain(speed.each_batch(rows, keep, b.scratch("checkpoint"), interval=None))
    return b.spark.read.parquet(out).drop("batch")


@query("st6_checkpoint_recovery", o.using("windows", f"SELECT {_WINDOW} FROM windows"))
def st6(b: Binding) -> DataFrame:
    """A query stopped half way takes up its state and offsets again."""
    source, add_rest = _two_halves(b)
    table, checkpoint = _series(b), b.scratch("checkpoint")
    with b.stateful():
        for step in (lambda: None, add_rest):
            step()
            hourly = speed.hourly_rows(_windows(_rated(b, b.stream_of(source))))
            speed.drain(speed.start_hourly(hourly, table, checkpoint))
    return _hour_starts(b, table)


@query("st7_processing_trigger", o.using("readings", "SELECT event_id, station_id, date FROM readings"))
def st7(b: Binding) -> DataFrame:
    """The landing query on its interval, stopped when all that was there is filed."""
    path = b.scratch("lake")
    rows = b.event_stream.select("event_id", "station_id", "date")
    running = speed.land_stream(rows, path, b.scratch("checkpoint"), interval="1 second")
    running.processAllAvailable()
    running.stop()
    schema = "event_id bigint, station_id string, date string"
    return b.spark.read.schema(schema).parquet(path)


@query(
    "st8_late_rows_dropped",
    o.using("windows", f"SELECT {_WINDOW} FROM windows WHERE hour_start >= TIMESTAMP '{MID_MONTH}'"),
)
def st8(b: Binding) -> DataFrame:
    """The month's first half arrives after its second: all its hours are closed by then."""
    path = b.scratch("source")
    early = F.col("ts") < F.lit(MID_MONTH).cast("timestamp_ntz")
    b.events.where(~early).write.parquet(path)
    table, checkpoint = _series(b), b.scratch("checkpoint")
    with b.stateful():
        for step in (lambda: None, lambda: b.events.where(early).write.mode("append").parquet(path)):
            step()
            hourly = speed.hourly_rows(_windows(_rated(b, b.stream_of(path))))
            speed.drain(speed.start_hourly(hourly, table, checkpoint))
    return _hour_starts(b, table)


@query(
    "st9_two_queries",
    o.using(
        "realtime windows",
        """SELECT r.station_id, r.timestamp AS latest, r.aqi_index, w.hours FROM realtime r
 JOIN (SELECT station_id, count(*) AS hours FROM windows GROUP BY station_id) w ON r.station_id = w.station_id""",
    ),
)
def st9(b: Binding) -> DataFrame:
    """Live snapshot and hourly series fed by one rated stream, each with its own checkpoint."""
    live = keyed.snapshot_table(b.scratch("realtime"), schemas.REALTIME_VIEW)
    series = _series(b)
    with b.stateful():
        rated = _rated(b)
        speed.drain(
            speed.start_latest(rated, live, b.scratch("checkpoint")),
            speed.start_hourly(speed.hourly_rows(_windows(rated)), series, b.scratch("checkpoint")),
        )
    hours = series.read(b.spark).groupBy("station_id").agg(F.count("*").alias("hours"))
    latest = without_zone(live.read(b.spark)).select(
        "station_id", F.col("timestamp").alias("latest"), "aqi_index"
    )
    return latest.join(hours, "station_id")
