from __future__ import annotations

from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.__main__ import main
from aerolith.plans import daily_state, views
from aerolith.sinks import tables


def land(spark, lake, rows):
    df = spark.createDataFrame(rows, "station_id string, t string, pm25 double, temperature double, humidity double, no2 double")
    readings = df.selectExpr(
        "station_id", "cast(t as timestamp) as timestamp", "substring(t, 1, 10) as date", "pm25", "temperature", "humidity", "no2"
    )
    readings.select(*schemas.READING.names).write.mode("append").partitionBy("date").parquet(lake)


def test_three_daily_runs_equal_a_full_rebuild(spark, tmp_path, rows_of):
    lake, state, root, file = (str(tmp_path / n) for n in ("lake", "state", "views", "stations.csv"))
    spark.createDataFrame([("A", "Alpha", "North"), ("B", "Beta", "South")], "station_id string, province string, region string").write.csv(
        file, header=True
    )
    for day in range(1, 10):
        rows = [
            (s, f"2026-04-0{day} {h:02d}:15:00", None if h == 3 else 7.3 * h + day, 10.0 + h / 3 + day, 50.0 + h, h / 7)
            for s in "ABX"
            for h in range(0, 24, 1 + day % 3)
            if day != 5  # a day without any reading
        ]
        land(spark, lake, rows) if rows else None
    seen = []
    for as_of in ("2026-04-08", "2026-04-09", "2026-04-10"):
        seen.append(daily_state.run_daily_increment(spark, file, lake, state, root, as_of, days=4))
    assert seen == [["2026-04-04", "2026-04-05", "2026-04-06", "2026-04-07"], ["2026-04-08"], ["2026-04-09"]]

    def views_equal_rebuild():
        stations = spark.read.csv(file, header=True)
        raw = spark.read.schema(schemas.READING).parquet(lake).where("date between '2026-04-06' and '2026-04-09'")
        daily, summary = tables.scan_view(spark, root, "daily"), tables.scan_view(spark, root, "summary")
        assert rows_of(daily, "date", "station_id") == rows_of(views.daily_view(raw, stations).select(daily.columns), "date", "station_id")
        assert rows_of(summary, "station_id") == rows_of(views.summary_view(raw, stations).select(summary.columns), "station_id")
        assert daily.count() == 12 and daily.where("region is null").count() == 4

    views_equal_rebuild()
    enriched = spark.read.parquet(f"{root}/weather_historical.parquet")
    assert {str(r.date) for r in enriched.select("date").distinct().collect()} == {f"2026-04-0{d}" for d in (4, 6, 7, 8, 9)}

    # A late row of a day that has state counts when the day is read again, through the job's own switch.
    land(spark, lake, [("A", "2026-04-07 23:59:00", 400.0, 39.0, 1.0, 1.0)])
    job = ["batch", "--stations", file, "--views", root, "--lake", lake, "--state", state, "--days", "4", "--as-of", "2026-04-10"]
    main(job, spark)
    assert tables.scan_view(spark, root, "daily").agg(F.max("max_temp")).first()[0] < 39
    main([*job, "--again", "2026-04-07"], spark)
    assert tables.scan_view(spark, root, "daily").agg(F.max("max_temp")).first()[0] == 39
    views_equal_rebuild()


def test_states_outside_the_window_are_not_opened(spark, tmp_path):
    state = str(tmp_path / "state")
    rows = [(f"2026-04-0{d}", "A", *[1] * 8, 1.0, 1.0, 1, 1, 1, 1) for d in range(1, 6)]
    spark.createDataFrame(rows, daily_state.STATE).write.partitionBy("date").parquet(f"{state}/days")
    read = daily_state.read_state(spark, state, "2026-04-02", "2026-04-03")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "2026-04-02" in plan and "2026-04-03" in plan and read.count() == 2
    assert daily_state.known_days(spark, state) == {f"2026-04-0{d}" for d in range(1, 6)}
