from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerolith.operators import projections
from aerolith.plans import views
from aerolith.plans.serving import Serving
from aerolith.sinks import tables
from aerolith.sources import registry


@pytest.fixture
def readings_rows(readings):
    return readings(
        ("A", "2026-04-01 10:00", 10.0, 20.0, 50.0, 1.0),
        ("A", "2026-04-01 11:30", 60.0, 41.0, 50.0, 1.0),
        ("A", "2026-04-02 16:10", 160.0, 36.0, 60.0, 2.0),
        ("A", "2026-04-02 16:10", 160.0, 36.0, 60.0, 2.0),
        ("B", "2026-04-01 05:00", 5.0, 5.0, 70.0, 3.0),
        ("C", "2026-04-01 05:00", 5.0, 25.0, 70.0, 3.0),
    )


@pytest.fixture
def cities(spark):
    return spark.createDataFrame(
        [("A", 101, "Alpha"), ("B", 102, "Beta"), ("C", 103, "Gamma")],
        "station_id string, city_id int, province string",
    )


@pytest.fixture
def serving(readings_rows, stations, cities):
    return Serving(
        realtime_rows=views.realtime_view(readings_rows, stations),
        hourly_rows=views.hourly_view(readings_rows, stations),
        daily_rows=views.daily_view(readings_rows, stations),
        summary_rows=views.summary_view(readings_rows.where("station_id <> 'C'"), stations),
        registry=cities,
    )


def test_realtime(serving, rows_of, readings_rows, stations):
    got = rows_of(serving.realtime().select("station_id", "pm25", "aqi_index", "aqi_alert", "temp_alert"))
    assert got == [
        ("A", 160.0, 210, "Very Unhealthy", "Hot"),
        ("B", 5.0, 21, "Good", "Too Cold"),
        ("C", 5.0, 21, "Good", "Normal"),
    ]
    assert [r.station_id for r in serving.realtime(province="Beta").collect()] == ["B"]
    assert serving.realtime("A", "Beta").count() == 0
    history = Serving(realtime_rows=projections.rate(readings_rows.join(stations, "station_id")))
    columns = ["station_id", "pm25", "aqi_alert", "timestamp"]
    assert rows_of(history.realtime().select(columns)) == rows_of(serving.realtime().select(columns))


def test_series_and_timeline(serving, rows_of):
    assert rows_of(serving.realtime_series("A", 2).select("pm25")) == [(60.0,), (160.0,)]
    assert serving.realtime_series("A").count() == 3
    assert serving.realtime_series_all(1).count() == 3
    with pytest.raises(ValueError):
        serving.realtime_series("")
    # Shown in local time: 16:10 is 23:00 of the same day, 11:30 is 18:00.
    assert rows_of(serving.hourly("A").select("hour", "pm25")) == [(23, 160.0)]
    assert rows_of(serving.hourly("A", "2026-04-01").select("hour")) == [(17,), (18,)]
    assert rows_of(serving.hourly_all().select("station_id", "hour")) == [("A", 23), ("B", 12), ("C", 12)]
    assert serving.hourly("A", "2020-01-01").count() == 0


def test_daily(serving, rows_of):
    assert rows_of(serving.daily("A").select("date", "peak_aqi_hour")) == [("2026-04-01", 11), ("2026-04-02", 16)]
    assert rows_of(serving.daily("A", "2026-04-02").select("date")) == [("2026-04-02",)]
    assert serving.daily_all(None, "2026-04-01").count() == 3
    with pytest.raises(ValueError):
        serving.daily(None)


def test_stats(serving, rows_of):
    stats = serving.stats()
    assert [r.station_id for r in stats["top_hottest_stations"].collect()] == ["A", "B"]
    assert rows_of(stats["national"]) == [(19.15, 51.25)]
    assert [r.province for r in serving.provinces().collect()] == ["Alpha", "Beta"]
    nothing = Serving(summary_rows=serving.summary_rows.limit(0)).stats()
    assert rows_of(nothing["national"]) == [(None, None)]
    by_city = serving.city_stats()
    assert rows_of(by_city["top_polluted_cities"]) == [
        (1, 101, "Alpha", 33.3, 173),
        (2, 102, "Beta", 5.0, 21),
    ]
    assert rows_of(by_city["national"]) == [(19.15, 140)]


def test_alerts(serving, rows_of):
    every = rows_of(serving.alerts().select("station_id", "alert_type", "level", "value"), "station_id", "alert_type")
    assert every == [
        ("A", "Air Quality", "Very Unhealthy", 210.0),
        ("A", "Temperature", "Hot", 36.0),
        ("B", "Temperature", "Too Cold", 5.0),
    ]
    assert serving.alerts(severity="aqi").count() == 1
    assert serving.alerts(severity="temp").count() == 2
    assert serving.alerts(severity="unknown").count() == 0
    assert serving.alerts(province="Beta").count() == 1
    by_city = rows_of(serving.city_alerts().select("city_id", "alert_type", "threshold_exceeded"), 1, 2)
    assert by_city == [(101, "Heatwave", 35), (101, "Pollution Spike", 150), (102, "Heatwave", 35)]


def test_compare(serving, rows_of):
    row = serving.compare("A").first()
    assert (row.current_temp, row.historical_avg_temp, row.temp_deviation) == (36.0, 33.3, 2.7)
    assert (row.current_pm25, row.historical_avg_pm25, row.pm25_deviation) == (160.0, 97.5, 62.5)
    assert serving.compare("C").count() == 0
    assert serving.compare("nowhere").count() == 0
    assert serving.compare_all().count() == 2
    by_city = serving.city_compare().orderBy("city_id").first()
    assert (by_city.city_id, by_city.city_name, by_city.current_aqi) == (101, "Alpha", 210)
    assert (by_city.historical_avg_aqi, by_city.aqi_deviation) == (173, 37)


def test_provinces_table_and_cards(serving, rows_of):
    table = serving.provinces_table()
    assert rows_of(table.orderBy("rank").select("rank", "station_id")) == [(1, "A"), (2, "B"), (3, "C")]
    south = serving.provinces_table("South", " MMA", "temp", "asc")
    assert rows_of(south.select("station_id", "rank", "aqi_category", "is_anomaly")) == [("C", 1, "Good", False)]
    assert str(serving.last_updated().first()[0]) == "2026-04-02 16:10:00"
    card = serving.city_card("B").first()
    assert (card.city_id, card.city_name, card.is_anomaly, card.aqi_category) == (102, "Beta", True, "Good")
    assert serving.city_cards().count() == 3


def test_daily_batch_job(spark, readings, tmp_path, rows_of):
    stations_path = str(tmp_path / "stations.csv")
    registry.station_registry(spark).select("station_id", "province", "region").write.csv(stations_path, header=True)
    rows = readings(
        ("HN01", "2026-04-01 05:00", 10.0, 36.0, 50.0, 1.0),
        ("HN01", "2026-04-30 05:00", 20.0, 21.0, 50.0, 1.0),
        ("HN01", "2026-05-01 05:00", 99.0, 99.0, 50.0, 1.0),
        ("CM01", "2026-03-31 05:00", 99.0, 99.0, 50.0, 1.0),
        ("CM01", "2026-04-15 05:00", 200.0, 30.0, 50.0, 1.0),
        ("ZZ", "2026-04-15 06:00", 1.0, 30.0, 50.0, 1.0),
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    lake_path, root = str(tmp_path / "lake"), str(tmp_path / "out")
    rows.write.partitionBy("date").parquet(lake_path)
    for _ in range(2):
        views.run_daily_batch(spark, stations_path, root, "2026-05-01", lake_path=lake_path)
    daily = tables.scan_view(spark, root, "daily").select("date", "station_id", "province", "avg_pm25")
    assert rows_of(daily, "date", "station_id") == [
        ("2026-04-01", "HN01", "Ha Noi", 10.0),
        ("2026-04-15", "CM01", "Ca Mau", 200.0),
        ("2026-04-15", "ZZ", None, 1.0),
        ("2026-04-30", "HN01", "Ha Noi", 20.0),
    ]
    summary = tables.scan_view(spark, root, "summary").select("station_id", "avg_temp", "max_temp", "record_count")
    assert rows_of(summary, "station_id") == [("CM01", 30.0, 30.0, 1), ("HN01", 28.5, 36.0, 2), ("ZZ", 30.0, 30.0, 1)]
    enriched = spark.read.parquet(f"{root}/weather_historical.parquet")
    assert {(r.region, r.weather_condition) for r in enriched.collect()} == {
        ("North", "Extreme Heat"),
        ("North", "Normal"),
        ("South", "Hazardous"),
        (None, "Normal"),
    }
    north = enriched.where("region = 'North' and date = '2026-04-30'")
    assert "PartitionFilters: [isnotnull(region" in north._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_serving_plans(serving):
    for df in (serving.realtime(), serving.compare_all(), serving.alerts(), serving.city_compare()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
