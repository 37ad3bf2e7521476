from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aerolith.functions.rounding import mean
from aerolith.operators import complete, filters, joins, latest, projections, ranking, rollups
from aerolith.plans import views


@pytest.fixture
def sample(readings):
    return readings(
        ("A", "2026-04-01 00:10", 10.0, 20.0, 50.0, 1.0),
        ("A", "2026-04-01 05:10", 60.0, 22.5, 70.0, 3.0),
        ("A", "2026-04-01 09:10", 60.0, 36.0, None, 2.0),
        ("A", "2026-04-02 03:10", None, None, 40.0, None),
        ("B", "2026-04-01 23:59", 200.0, -3.5, 90.0, 5.5),
        ("X", "2026-04-01 01:00", 5.0, 41.0, 10.0, 0.5),
    )


def test_daily_rollup(sample, stations, rows_of):
    daily = rollups.daily_rollup(joins.enrich_left(sample, stations))
    got = rows_of(daily, "date", "station_id")
    assert got == [
        ("2026-04-01", "A", "Alpha", "North", 26.2, 36.0, 20.0, 60.0, 43.33, 2.0, 116.0, 9, 3),
        ("2026-04-01", "B", "Beta", "South", -3.5, -3.5, -3.5, 90.0, 200.0, 5.5, 250.0, 23, 1),
        ("2026-04-01", "X", None, None, 41.0, 41.0, 41.0, 10.0, 5.0, 0.5, 21.0, 1, 1),
        ("2026-04-02", "A", "Alpha", "North", None, None, None, 40.0, None, None, 0.0, 3, 1),
    ]


@pytest.mark.parametrize("how", ["double", "fixed"])
def test_views_aggregate_before_the_lookup_with_the_same_result(sample, stations, rows_of, how):
    enriched = joins.enrich_left(sample, stations)
    daily = rollups.daily_rollup(enriched, how)
    assert rows_of(views.daily_view(sample, stations, how), "date", "station_id") == rows_of(
        daily, "date", "station_id"
    )
    as_dates = sample.withColumn("date", F.col("date").cast("date"))
    assert rows_of(views.daily_view(as_dates, stations, how), "date", "station_id") == rows_of(
        daily, "date", "station_id"
    )
    summary = rollups.station_summary(enriched, how)
    assert rows_of(views.summary_view(sample, stations, how), "station_id") == rows_of(summary, "station_id")
    state = rollups.daily_partials(sample, how=how)
    assert rows_of(views.summary_from(state, stations, how), "station_id") == rows_of(summary, "station_id")
    hourly = rollups.hourly_rollup(projections.rate(enriched.where("region is not null")), how=how)
    early = views.hourly_view(sample, stations, how, tz_offset_hours=0)
    assert rows_of(early.select("station_id", "timestamp", "avg_pm25", "max_aqi"), 1, 2) == rows_of(
        hourly.select("station_id", "window.start", "avg_pm25", "max_aqi"), 1, 2
    )


def test_peak_hour_ties_and_struct(readings, rows_of):
    df = readings(
        ("A", "2026-04-01 03:00", 60.0, 1.0, 1.0, 1.0),
        ("A", "2026-04-01 17:00", 60.0, 1.0, 1.0, 1.0),
        ("A", "2026-04-01 20:00", -9.0, 1.0, 1.0, 1.0),
        ("B", "2026-04-01 20:00", -9.0, 1.0, 1.0, 1.0),
        ("C", "2026-04-01 20:00", None, 1.0, 1.0, 1.0),
    )
    aqi = rollups.rules.pm25_to_aqi_sql("pm25", "null")
    got = df.groupBy("station_id").agg(
        rollups.peak_hour(aqi, "hour(timestamp)").alias("last"),
        rollups.peak_hour(aqi, "hour(timestamp)", tie="first", empty=0).alias("first"),
        rollups.peak_struct(aqi, "hour(timestamp)").alias("peak"),
    )
    expected = df.groupBy("station_id").agg(F.max(F.expr(f"struct({aqi} AS aqi, hour(timestamp) AS hour)")).alias("p"))
    assert [(r.station_id, r.last, r.first) for r in got.orderBy("station_id").collect()] == [
        ("A", 17, 3),
        ("B", 20, 20),
        ("C", None, 0),
    ]
    peaks = {r.station_id: tuple(r.peak) for r in got.collect()}
    want = {r.station_id: tuple(r.p) for r in expected.collect()}
    assert peaks["A"] == want["A"] and peaks["B"] == want["B"]


def test_rollups_hash_aggregate(sample, stations):
    for df in (
        rollups.daily_rollup(joins.enrich_left(sample, stations)),
        rollups.station_summary(joins.enrich_left(sample, stations), "fixed"),
        rollups.hourly_rollup(projections.rate(joins.enrich_left(sample, stations))),
        joins.merge_feeds(*[sample.withColumnRenamed("timestamp", "time")] * 3),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
        assert "partial_" in plan


def test_national_means(spark, rows_of):
    summary = spark.createDataFrame([(20.0, 1.25), (20.25, None), (20.0, 1.0)], "avg_temp double, avg_pm25 double")
    assert rows_of(rollups.national_means(summary)) == [(20.08, 1.12)]
    assert rows_of(rollups.national_means(summary, "fixed")) == [(20.08, 1.12)]
    assert rows_of(rollups.national_means(summary.limit(0))) == [(None, None)]


def test_region_max(spark, rows_of):
    lines = [
        "date,region,temp,humidity",
        "2026-01-01,North,-5.5,10",
        "2026-01-02,North,-2.5,10",
        "2026-01-02,South,30,10",
        "2026-01-02,South,31",
        "2026-01-02,South,99,1,2",
        "2026-01-02,South,98,",
        "2026-01-03,South,32.5,7,,",
        "2026-01-03,South,warm,7",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    assert rows_of(rollups.region_max_temperature(df), "region") == [("North", -2.5), ("South", 32.5)]


def test_region_weather(spark, rows_of):
    readings = spark.createDataFrame(
        [("A", 10.0, 1.0), ("A", 20.0, 0.0), ("B", 30.0, 2.5), ("C", None, 4.0), ("X", 5.0, None)],
        "station_id string, temp double, precipitation double",
    )
    stations = spark.createDataFrame([("A", "North"), ("B", "North"), ("C", "South")], "station_id string, region string")
    got = [tuple(r) for r in rollups.region_weather(readings, stations).collect()]
    assert got == [("North", 20.0, 3.5), (None, 5.0, None), ("South", None, 4.0)]


def test_latest_per_key(readings, rows_of):
    df = readings(
        ("A", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0),
        ("A", "2026-04-01 06:00", 2.0, None, 1.0, 1.0),
        ("A", "2026-04-01 06:00", 3.0, 1.0, None, 1.0),
        ("B", "2026-04-01 04:00", 4.0, 1.0, 1.0, 1.0),
    )
    got = latest.latest_per_key(df, ["station_id"], ["timestamp"])
    assert got.columns == df.columns
    assert rows_of(got.select("station_id", "pm25", "temperature", "humidity"), "station_id") == [
        ("A", 3.0, 1.0, None),
        ("B", 4.0, 1.0, 1.0),
    ]


@pytest.mark.parametrize(
    ("asked", "given"), [(None, 30), (0, 30), ("x", 30), ("7", 7), ("12abc", 12), ("7.9", 7), (-4, 1), (501, 500), (12, 12)]
)
def test_series_limit(asked, given):
    assert latest.clamp_limit(asked) == given


def test_last_n_limits_before_the_shuffle(readings, rows_of):
    df = readings(*[("A", f"2026-04-01 {h:02d}:00", float(h), 1.0, 1.0, 1.0) for h in range(20)])
    got = latest.last_n(df, 3)
    assert rows_of(got.select("pm25"), "pm25") == [(17.0,), (18.0,), (19.0,)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_latest_day(readings, rows_of):
    df = readings(
        ("A", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0),
        ("A", "2026-04-02 06:00", 2.0, 1.0, 1.0, 1.0),
        ("A", "2026-04-02 07:00", 3.0, 1.0, 1.0, 1.0),
        ("B", "2026-04-01 04:00", 4.0, 1.0, 1.0, 1.0),
    )
    assert rows_of(latest.latest_day(df).select("pm25"), "pm25") == [(2.0,), (3.0,), (4.0,)]


def hours(station, day, count, **gaps):
    start = datetime.fromisoformat(day)
    out = []
    for slot in range(count):
        t = start + timedelta(minutes=50 * slot if count > 24 else 60 * slot)
        values = {"pm25": float(slot), "temperature": 20.0, "humidity": 50.0, "no2": 1.0}
        for name, at in gaps.items():
            if slot == at:
                values[name] = None
        out.append(
            (station, t.isoformat(" "), values["pm25"], values["temperature"], values["humidity"], values["no2"])
        )
    return out


def test_complete_days(readings, rows_of):
    df = readings(
        *hours("A", "2026-04-01", 24),
        *hours("A", "2026-04-02", 23),
        *hours("A", "2026-04-03", 24, pm25=5),
        *hours("A", "2026-04-04", 24, no2=5, humidity=7),
        *hours("A", "2026-04-05", 26, pm25=25),
        *hours("B", "2026-04-01", 24, temperature=0),
    )
    got = complete.complete_days(df)
    per_day = got.groupBy("station_id", "date").agg(F.count("*"), F.min("slot"), F.max("slot"))
    assert rows_of(per_day, "date") == [
        ("A", "2026-04-01", 24, 0, 23),
        ("A", "2026-04-04", 24, 0, 23),
        ("A", "2026-04-05", 24, 0, 23),
    ]


def test_redating_is_dense_and_bounded(readings, stations, rows_of):
    days = [datetime(2026, 1, 1) + timedelta(days=2 * i) for i in range(33)]
    df = readings(*[row for d in days for row in hours("A", d.date().isoformat(), 24)])
    redated = complete.redate_recent(complete.complete_days(df), "2026-06-01", 30)
    per_day = redated.groupBy("date").agg(F.count("*").alias("n"), F.min("timestamp").cast("string").alias("t"))
    got = rows_of(per_day, "date")
    assert len(got) == 30 and got[0][0] == "2026-05-03" and got[-1] == ("2026-06-01", 24, "2026-06-01 00:00:00")
    assert {n for _, n, _ in got} == {24}
    daily = rollups.complete_daily(joins.enrich_left(redated, stations))
    assert {(r.avg_humidity, r.peak_aqi_hour, r.record_count) for r in daily.collect()} == {(50.0, 23, 24)}
    summary = rollups.complete_summary(joins.enrich_left(redated, stations)).collect()
    assert len(summary) == 1 and summary[0].record_count == 30 * 24


def test_profile_for_today(readings, rows_of):
    df = readings(*hours("A", "2026-04-01", 24), *hours("A", "2026-04-02", 24), *hours("A", "2026-04-03", 5))
    got = complete.profile_for_today(complete.complete_days(df), datetime(2026, 6, 2, 1, 30))
    assert rows_of(got.select("date", F.col("timestamp").cast("string"), "pm25"), "pm25") == [
        ("2026-06-02", "2026-06-02 00:00:00", 0.0),
        ("2026-06-02", "2026-06-02 01:00:00", 1.0),
    ]


def test_enrichment_strategies_agree(sample, stations, rows_of):
    plain = rows_of(joins.enrich_left(sample, stations), "station_id", "timestamp")
    merged = joins.enrich_left(sample, stations, "merge")
    assert "SortMergeJoin" in merged._jdf.queryExecution().executedPlan().toString()
    assert rows_of(merged, "station_id", "timestamp") == plain
    salted = joins.enrich_left(sample, stations, salts=5)
    assert rows_of(salted.select(*merged.columns), "station_id", "timestamp") == plain
    known = rows_of(joins.enrich_inner(sample, stations), "station_id", "timestamp")
    assert known == [r for r in plain if r[0] != "X"]
    salted = joins.enrich_inner(sample, stations, salts=5)
    assert "SortMergeJoin" in salted._jdf.queryExecution().executedPlan().toString()
    assert rows_of(salted.select(*merged.columns), "station_id", "timestamp") == known
    with pytest.raises(ValueError):
        joins.enrich_left(sample, stations, "other")


def test_merge_feeds(spark, rows_of):
    weather = "station_id string, time string, temperature double, humidity double"
    forecast = spark.createDataFrame([("A", "t1", 20.04, None), ("A", "t2", None, 50.5)], weather)
    archive = spark.createDataFrame([("A", "t1", 1.0, 40.4), ("A", "t2", 2.0, 2.0), ("A", "t3", 3.0, 3.0)], weather)
    air = spark.createDataFrame(
        [("A", "t3", 9.95, 1.25), ("B", "t1", 1.0, None)], "station_id string, time string, pm25 double, no2 double"
    )
    assert rows_of(joins.merge_feeds(forecast, archive, air), "station_id", "time") == [
        ("A", "t1", 20.0, 40.0, None, None),
        ("A", "t2", 2.0, 51.0, None, None),
        ("A", "t3", 3.0, 3.0, 10.0, 1.3),
        ("B", "t1", None, None, 1.0, None),
    ]


def test_city_lookup_may_miss(spark, rows_of):
    registry = spark.createDataFrame([(7, "P"), (3, "P")], "city_id int, province string")
    df = spark.createDataFrame([("P",), ("Q",)], "province string")
    assert rows_of(joins.with_city(df, registry), "province") == [("P", 3), ("Q", None)]


def test_filters(sample, spark, rows_of):
    assert filters.rolling_window("2026-05-01") == ("2026-04-01", "2026-04-30")
    assert filters.history_window("2026-05-01") == ("2026-04-18", "2026-05-01")
    for column in ("date", "timestamp"):
        assert filters.date_range(sample, "2026-04-02", None, column).count() == 1
        assert filters.date_range(sample, None, "2026-04-01", column).count() == 5
        assert filters.date_range(sample, "2026-04-01", "2026-04-02", column).count() == 6
        assert filters.date_range(sample, column=column).count() == 6
    assert filters.match_optional(sample, station_id="", province=None).count() == 6
    df = spark.createDataFrame([("Ha Noi", "North"), ("Hue", "Central"), (None, "North")], "province string, region string")
    assert rows_of(filters.search(df, None, " HA ")) == [("Ha Noi", "North")]
    assert filters.search(df, "North", "").count() == 2
    raw = spark.createDataFrame([(1.0, "2026-04-01"), (None, "2026-04-01"), (2.0, "bad")], "temp double, date_string string")
    assert [(r.temp, str(r.record_date)) for r in filters.clean_records(raw).collect()] == [
        (1.0, "2026-04-01"),
        (2.0, "None"),
    ]


def test_sorting_and_ranks(spark, rows_of):
    df = spark.createDataFrame(
        [(f"S{i:03d}", None if i % 7 == 0 else float(i % 5)) for i in range(300)], "station_id string, v double"
    )
    down = [r[0] for r in rows_of(ranking.sort_rows(df, "v", "desc"))]
    up = [r[0] for r in rows_of(ranking.sort_rows(df, "v", "asc"))]
    assert down[-1] == "S294" and up[0] == "S000" and down[0] == "S004"
    ranked = ranking.global_rank(df, ranking.sort_key("v", "desc"), "station_id")
    assert [r[0] for r in rows_of(ranked.orderBy("rank").select("station_id"))] == down
    assert [r[0] for r in rows_of(ranked.orderBy("rank").select("rank"))] == list(range(1, 301))
    top = ranking.top_n(df, "v", 3)
    assert [r.station_id for r in top.collect()] == ["S004", "S009", "S019"]
    listed = ranking.share_of_max(ranking.rank_bounded(top, F.desc("v"), "station_id"), "v")
    assert {(r["rank"], r.share) for r in listed.collect()} == {(1, 1.0), (2, 1.0), (3, 1.0)}


def test_stamped_ingestion(sample):
    stamped = projections.stamp_ingestion(sample, datetime(2026, 5, 1, 6, 30)).first()
    assert stamped.date == "2026-05-01" and str(stamped.timestamp) == "2026-05-01 06:30:00"
    assert projections.stamp_ingestion(sample).select("date").distinct().count() == 1


def test_mean_of_three_decimals_as_the_jobs_take_it(spark):
    df = spark.createDataFrame([(10.004,), (10.004,), (10.009,)], "x double")
    assert df.agg(mean("x", 2).alias("m")).first().m == 10.01


def test_merge_feeds_with_a_repeated_hour(spark, rows_of):
    weather = spark.createDataFrame(
        [("A", "t", 0, None, 1.0), ("A", "t", 1, 5.0, 2.0)], "station_id string, time string, at int, temperature double, humidity double"
    )
    air = spark.createDataFrame([("A", "t", 0, 50.0, 1.0), ("A", "t", 1, 10.0, None)], "station_id string, time string, at int, pm25 double, no2 double")
    assert rows_of(joins.merge_feeds(weather, weather, air, position="at")) == [("A", "t", 5.0, 1.0, 10.0, None)]
