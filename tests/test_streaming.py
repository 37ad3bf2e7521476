from __future__ import annotations

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.operators import projections, rollups
from aerolith.sinks import keyed, tables
from aerolith.sources import messages
from aerolith.streaming import speed


@pytest.fixture
def feed(spark, tmp_path):
    """A folder of message files, and a way to add one."""
    folder = tmp_path / "feed"
    folder.mkdir()
    count = iter(range(100))

    def send(*rows):
        lines = []
        for station, at, pm25 in rows:
            reading = {"date": at[:10], "timestamp": at, "station_id": station, "pm25": pm25}
            lines.append(json.dumps(reading | {"temperature": 20.0, "humidity": 50.0, "no2": 1.0}))
        (folder / f"{next(count)}.txt").write_text("\n".join(lines) + "\n")

    send.path = str(folder)
    send.raw = lambda text: (folder / f"{next(count)}.txt").write_text(text + "\n")
    send.messages = lambda: messages.file_messages(spark, send.path)
    return send


def paths(tmp_path, *names):
    return [str(tmp_path / n) for n in names]


def test_landing_files_valid_rows_once_and_quarantines_the_rest(spark, feed, tmp_path):
    lake, held, check1, check2 = paths(tmp_path, "lake", "held", "c1", "c2")
    feed(("A", "2026-04-01 05:00:00", 1.0), ("B", "2026-04-02 05:00:00", 2.0))
    feed.raw("not json")

    def run():
        raw = feed.messages()
        landed = messages.valid_readings(messages.decode_readings(raw))
        speed.drain(
            speed.land_stream(landed, lake, check1, interval=None),
            speed.quarantine_stream(messages.quarantined(raw), held, check2, interval=None),
        )
        return spark.read.schema(schemas.READING).parquet(lake)

    assert run().count() == 2
    assert run().count() == 2
    feed(("A", "2026-04-01 06:00:00", 3.0))
    assert {r.date for r in run().collect()} == {"2026-04-01", "2026-04-02"}
    assert run().count() == 3
    assert [r.value for r in spark.read.text(held).collect()] == ["not json"]


def test_hourly_series_follows_the_running_hour_and_drops_late_rows(spark, feed, stations, tmp_path):
    path, check = paths(tmp_path, "hourly", "c")
    table = keyed.series_table(path, schemas.HOURLY_VIEW)
    dropped = []

    def run():
        readings = messages.decode_readings(feed.messages())
        windows = speed.hourly_stream(
            speed.rated_stream(readings, stations), keys=("station_id", "province", "region")
        )
        with speed.state_settings(spark, 4):
            query = speed.start_hourly(speed.hourly_rows(windows), table, check)
            speed.drain(query)
        dropped.extend(
            op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
        )
        rows = table.read(spark).select("_id", "avg_pm25", "max_aqi", "aqi_alert", "date").orderBy("_id")
        return [tuple(r) for r in rows.collect()]

    feed(("A", "2026-04-01 10:05:00", 10.0), ("X", "2026-04-01 10:05:00", 10.0))
    assert run() == [("A_2026-04-01 17:00:00", 10.0, 42, "Good", "2026-04-01")]
    feed(("A", "2026-04-01 10:20:00", 20.0), ("A", "2026-04-01 18:00:00", 300.0))
    assert run() == [
        ("A_2026-04-01 17:00:00", 15.0, 68, "Moderate", "2026-04-01"),
        ("A_2026-04-02 01:00:00", 300.0, 350, "Hazardous", "2026-04-02"),
    ]
    assert sum(dropped) == 0
    feed(("A", "2026-04-01 10:50:00", 99.0))
    assert run()[0] == ("A_2026-04-01 17:00:00", 15.0, 68, "Moderate", "2026-04-01")
    assert sum(dropped) == 1


def test_stream_equals_batch(spark, feed, stations, tmp_path):
    path, check = paths(tmp_path, "hourly", "c")
    rows = [(s, f"2026-04-01 {h:02d}:{m:02d}:00", h + m / 10) for s in "AB" for h in range(6) for m in (0, 20, 59)]
    feed(*rows)
    table = keyed.series_table(path, schemas.HOURLY_VIEW)
    readings = messages.decode_readings(feed.messages())
    windows = speed.hourly_stream(speed.rated_stream(readings, stations), keys=rollups.SUMMARY_KEYS, how="fixed")
    speed.drain(speed.start_hourly(speed.hourly_rows(windows), table, check))
    at_rest = messages.decode_readings(spark.read.text(feed.path))
    batch = speed.hourly_rows(
        rollups.hourly_rollup(
            projections.rate(at_rest.join(stations, "station_id")), keys=rollups.SUMMARY_KEYS, how="fixed"
        )
    )
    columns = sorted(c for c in batch.columns)
    assert sorted(map(str, table.read(spark).select(columns).collect())) == sorted(
        map(str, batch.select(columns).collect())
    )


def test_snapshot_and_series_run_side_by_side(spark, feed, stations, tmp_path):
    live_path, series_path, c1, c2 = paths(tmp_path, "live", "series", "c1", "c2")
    feed(("A", "2026-04-01 10:05:00", 10.0), ("A", "2026-04-01 10:15:00", 20.0), ("B", "2026-04-01 11:05:00", 5.0))
    live = keyed.snapshot_table(live_path, schemas.REALTIME_VIEW)
    series = keyed.series_table(series_path, schemas.HOURLY_VIEW)
    rated = speed.rated_stream(messages.decode_readings(feed.messages()), stations)
    windows = speed.hourly_stream(rated, keys=rollups.SUMMARY_KEYS)
    speed.drain(
        speed.start_latest(rated, live, c1), speed.start_hourly(speed.hourly_rows(windows), series, c2)
    )
    newest = live.read(spark).select("station_id", "pm25").orderBy("station_id").collect()
    assert [tuple(r) for r in newest] == [("A", 20.0), ("B", 5.0)]
    assert series.read(spark).count() == 2


def test_one_failing_query_stops_the_other(spark, feed, tmp_path):
    lake, c1, c2 = paths(tmp_path, "lake", "c1", "c2")
    feed(("A", "2026-04-01 10:05:00", 10.0))
    readings = messages.decode_readings(feed.messages())

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    steady = speed.land_stream(readings, lake, c1, interval="1 second")
    broken = speed.each_batch(readings, fail, c2, interval=None)
    with pytest.raises(StreamingQueryException):
        speed.run_until_any_stops([steady, broken])
    assert not steady.isActive and not broken.isActive


def test_empty_batches_are_skipped(spark, feed, tmp_path):
    (check,) = paths(tmp_path, "c")
    seen = []
    feed(("A", "2026-04-01 10:05:00", 10.0))
    nothing = messages.decode_readings(feed.messages()).where("pm25 > 1000")
    speed.drain(speed.each_batch(nothing, lambda b, i: seen.append(i), check, interval=None))
    assert seen == []


def test_state_settings_are_put_back(spark):
    partitions, provider = "spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(partitions), spark.conf.get(provider)
    with speed.state_settings(spark, 3):
        assert spark.conf.get(partitions) == "3" and "RocksDB" in spark.conf.get(provider)
    assert (spark.conf.get(partitions), spark.conf.get(provider)) == before


def test_kafka_without_its_connector_says_so(spark, feed, tmp_path):
    with pytest.raises(Exception, match="kafka"):
        speed.send_stream(feed.messages(), "nowhere:9092", "topic", str(tmp_path / "c"))
    with pytest.raises(Exception, match="kafka"):
        messages.kafka_messages(spark, "nowhere:9092", "topic")
    with pytest.raises(Exception, match="kafka"):
        tables.send_messages(spark.createDataFrame([("x",)], "value string"), "nowhere:9092", "topic")


def test_a_replayed_stream_batch_leaves_what_came_after(spark, feed, stations, tmp_path):
    """The driver is lost after a batch's upsert and before its commit; a fill comes between that and the replay."""
    path, check = paths(tmp_path, "hourly", "c")
    table = keyed.series_table(path, schemas.HOURLY_VIEW)

    def run():
        rated = speed.rated_stream(messages.decode_readings(feed.messages()), stations)
        windows = speed.hourly_stream(rated, keys=("station_id", "province", "region"))
        with speed.state_settings(spark, 4):
            speed.drain(speed.start_hourly(speed.hourly_rows(windows), table, check))
        return {r._id: r.avg_pm25 for r in table.read(spark).collect()}

    feed(("A", "2026-04-01 10:05:00", 10.0), ("B", "2026-04-01 10:05:00", 20.0))
    assert set(run().values()) == {10.0, 20.0}
    filled = table.read(spark).where("station_id = 'A'").select("_id", "date", F.lit(99.0).alias("avg_pm25"))
    table.upsert(filled, writer="fill")
    (tmp_path / "c" / "commits" / "0").unlink()
    (tmp_path / "c" / "commits" / ".0.crc").unlink(missing_ok=True)
    assert set(run().values()) == {99.0, 20.0}
    feed(("A", "2026-04-01 10:15:00", 30.0))
    after = run()
    assert set(after.values()) == {20.0} and len(after) == 2
