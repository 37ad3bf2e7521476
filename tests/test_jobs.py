from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.__main__ import main
from aerolith.operators import rollups
from aerolith.plans import backfill
from aerolith.plans.serving import Serving
from aerolith.sinks import keyed, tables
from aerolith.sources import lake, registry


@pytest.fixture
def stations_file(spark, tmp_path):
    path = str(tmp_path / "stations.csv")
    registry.station_registry(spark).select("station_id", "province", "region").write.csv(path, header=True)
    return path


def test_the_three_jobs_from_feed_to_serving(spark, tmp_path, stations_file, rows_of):
    feed = tmp_path / "feed"
    feed.mkdir()
    rows = [
        ("HN01", "2026-04-29 03:00:00", 10.0, 20.0),
        ("HN01", "2026-04-30 03:10:00", 160.0, 36.0),
        ("CM01", "2026-04-30 04:00:00", 5.0, 30.0),
        ("??", "2026-04-30 04:00:00", 5.0, 30.0),
    ]
    text = [
        json.dumps(
            {"date": t[:10], "timestamp": t, "station_id": s, "pm25": p, "temperature": c, "humidity": 50, "no2": 1}
        )
        for s, t, p, c in rows
    ]
    (feed / "0.txt").write_text("\n".join([*text, "garbage"]) + "\n")
    lake_dir, views, checks = (str(tmp_path / n) for n in ("lake", "views", "checks"))
    common = ["--feed", str(feed), "--checkpoints", checks, "--once"]
    main(["land", "--lake", lake_dir, *common], spark)
    main(
        ["speed", "--stations", stations_file, "--views", views, "--state-partitions", "4", *common], spark
    )
    main(["batch", "--stations", stations_file, "--views", views, "--lake", lake_dir, "--as-of", "2026-05-01"], spark)
    assert [r.value for r in spark.read.text(f"{lake_dir}_rejected").collect()] == ["garbage"]
    live = keyed.snapshot_table(f"{views}/realtime", schemas.REALTIME_VIEW).read(spark)
    serving = Serving(
        realtime_rows=live.drop(keyed.SNAPSHOT_SLOT),
        hourly_rows=keyed.series_table(f"{views}/hourly", schemas.HOURLY_VIEW).read(spark),
        daily_rows=tables.scan_view(spark, views, "daily"),
        summary_rows=tables.scan_view(spark, views, "summary"),
        registry=registry.station_registry(spark),
        snapshot=True,
    )
    assert [r.station_id for r in serving.realtime().collect()] == ["CM01", "HN01"]
    assert [(r.hour, r.pm25) for r in serving.hourly("HN01").collect()] == [(10, 160.0)]
    assert [(r.date, r.avg_pm25) for r in serving.daily("HN01").collect()] == [("2026-04-29", 10.0), ("2026-04-30", 160.0)]
    row = serving.city_compare().where("city_id = 101").first()
    assert (row.city_name, row.current_aqi, row.historical_avg_aqi) == ("Ha Noi", 210, 166)
    assert [r.alert_type for r in serving.city_alerts().orderBy("alert_type").collect()] == ["Heatwave", "Pollution Spike"]
    assert serving.provinces().count() == 3


def payloads(spark, kind, rows):
    return spark.createDataFrame(rows, f"station_id string, payload {kind.simpleString()}")


@pytest.fixture
def feeds(spark):
    """33 whole days of HN01 (archive), the last of them in the forecast too, and a torn day after."""
    start = datetime(2026, 3, 1)
    times = [(start + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in range(33 * 24 + 10)]
    archive = (times, [20.0] * len(times), [50.0] * len(times))
    recent = times[-34:]
    forecast = (recent, [30.04] * len(recent), [60.6] * len(recent))
    air = (times, [float(i % 24) for i in range(len(times))], [1.0] * len(times))
    return (
        payloads(spark, schemas.WEATHER_ARRAYS, [("HN01", forecast), ("NOPE", forecast)]),
        payloads(spark, schemas.WEATHER_ARRAYS, [("HN01", archive)]),
        payloads(spark, schemas.AIR_ARRAYS, [("HN01", air)]),
    )


def test_backfill_from_feeds(spark, feeds, stations_file, tmp_path, rows_of):
    root = str(tmp_path / "views")
    stations = registry.scan_stations(spark, stations_file)
    rows = backfill.feed_rows(*feeds)
    history = backfill.keep(backfill.recent_history(rows, stations, "2026-06-01"))
    assert history.count() == 30 * 24
    backfill.seed_views(history, root)
    daily = tables.scan_view(spark, root, "daily").orderBy("date").collect()
    assert len(daily) == 30 and daily[0].date == "2026-05-03" and daily[-1].date == "2026-06-01"
    assert (daily[0].avg_temp, daily[-1].avg_temp, daily[-1].avg_humidity) == (20.0, 30.0, 61.0)
    assert {(r.peak_aqi_hour, r.record_count) for r in daily} == {(23, 24)}
    summary = tables.scan_view(spark, root, "summary").first()
    assert (summary.station_id, summary.record_count, summary.max_temp) == ("HN01", 720, 30.0)
    assert str(tables.scan_view(spark, root, "realtime").first().timestamp) == "2026-06-01 23:00:00"
    assert tables.scan_view(spark, root, "hourly").count() == 720

    out = str(tmp_path / "history")
    backfill.export_history(history, out)
    back = lake.scan_history_csv(spark, out)
    assert back.count() == 720 and back.where("station_id is null or pm25 is null").count() == 0
    assert rollups.row_count(back.where("date = '2026-06-01'")).first()[0] == 24

    series = keyed.series_table(str(tmp_path / "series"), schemas.HOURLY_VIEW)
    for _ in range(2):
        backfill.fill_today(rows, stations, datetime(2026, 6, 2, 2, 15), series)
        got = series.read(spark).select("_id", F.col("timestamp").cast("string"), "temperature", "aqi_index")
        assert rows_of(got, "_id") == [
            ("HN01_2026-06-02 00:00:00", "2026-06-02 00:00:00", 30.0, 0.0),
            ("HN01_2026-06-02 01:00:00", "2026-06-02 01:00:00", 30.0, 4.0),
            ("HN01_2026-06-02 02:00:00", "2026-06-02 02:00:00", 30.0, 8.0),
        ]


def test_fill_jobs(spark, feeds, stations_file, tmp_path, rows_of):
    """The backfills as jobs of their own: views, batch views, today's hours and the history file."""
    paths = {}
    for name, df in zip(("forecast", "archive", "air"), feeds, strict=True):
        paths[name] = str(tmp_path / name)
        df.write.json(paths[name])
    common = ["fill", "--stations", stations_file, *[x for n, p in paths.items() for x in (f"--{n}", p)], "--anchor", "2026-06-01"]
    root, history = str(tmp_path / "views"), str(tmp_path / "history")
    main([*common, "--what", "views,history", "--views", root, "--history", history], spark)
    assert tables.scan_view(spark, root, "daily").count() == 30 and tables.scan_view(spark, root, "hourly").count() == 720
    assert lake.scan_history_csv(spark, history).count() == 720
    batch = str(tmp_path / "batch")
    main([*common, "--what", "batch", "--views", batch], spark)
    assert rows_of(tables.scan_view(spark, batch, "daily"), "date") == rows_of(tables.scan_view(spark, root, "daily"), "date")
    for _ in range(2):
        main([*common, "--what", "today", "--views", batch, "--series", "live", "--now", "2026-06-02T02:15"], spark)
        series = keyed.series_table(f"{batch}/live", schemas.HOURLY_VIEW).read(spark)
        assert [r.aqi_index for r in series.orderBy("_id").collect()] == [0.0, 4.0, 8.0]
    with pytest.raises(ValueError, match="unknown"):
        main([*common, "--what", "all"], spark)
