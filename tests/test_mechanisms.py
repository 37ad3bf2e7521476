"""The Spark mechanisms behind the operators: plans, skew, readers beside writers, counts of a running stream."""

from __future__ import annotations

import json
import random
import threading

import pytest
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.operators import joins, latest, ranking
from aerolith.plans.serving import Serving
from aerolith.sinks import keyed, tables
from aerolith.sources import messages
from aerolith.streaming import speed


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_rows_equal_the_one_pass_form(spark, tmp_path):
    rng = random.Random(4)
    rows = [
        (rng.choice(["A", "B", None]), rng.choice([None, "2026-04-01 05:00", "2026-04-01 06:00", "2026-04-02 01:00"]),
         rng.choice([None, 1, 2]), rng.choice([None, 0.5, 1.5, float("nan")]), rng.choice("xyz"))
        for _ in range(60)
    ] + [("C", None, 1, 1.0, "x"), ("C", None, 2, 1.0, "x"), ("old", "2020-01-01 00:00", None, None, "z")]
    df = spark.createDataFrame(rows, "k string, t string, e int, v double, s string").withColumn("t", F.col("t").cast("timestamp"))
    path = str(tmp_path / "rows")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    for tiebreak in ((), ("e",)):
        late = latest.latest_rows(stored, ["k"], "t", tiebreak)
        one = latest.latest_per_key(stored, ["k"], ["t"], tiebreak)
        assert sorted(map(repr, late.collect())) == sorted(map(repr, one.select(late.columns).collect()))
    plan = plan_of(latest.latest_rows(stored, ["k"], "t", ("e",)))
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "Subquery" in plan
    # The bound is a filter of the scan itself.
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "s#" in line)
    assert "ubquery" in scan.split("DataFilters: ")[1].split("Format:")[0]


def test_lists_come_from_one_pass(spark, tmp_path, rows_of):
    path = str(tmp_path / "summary")
    rows = [(f"S{i:03d}", "p", "r", float(i % 17), float((i * 7) % 23) if i % 5 else None) for i in range(200)]
    spark.createDataFrame(rows, "station_id string, province string, region string, avg_temp double, avg_pm25 double").write.parquet(path)
    summary = spark.read.parquet(path)
    lists = ranking.top_lists(summary, {"a": "avg_temp", "b": "avg_pm25"}, 5)
    plan = plan_of(lists)
    assert plan.count("FileScan") == 1 and "WindowGroupLimit" in plan
    for name, metric in (("a", "avg_temp"), ("b", "avg_pm25")):
        want = rows_of(ranking.top_n(summary, metric, 5).select("station_id"))
        got = [(r.station_id,) for r in lists.where(F.col("list") == name).orderBy("place").collect()]
        assert got == want
    stats = Serving(summary_rows=summary).stats_table()
    assert sorted(r.section for r in stats.collect()) == ["hottest"] * 5 + ["national"] + ["polluted"] * 5


@pytest.fixture
def skewed(spark, tmp_path):
    """Readings of which a third are of one station, a sixth of another and a tenth of none."""
    hot = F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 6 == 1, "WARM").when(F.col("id") % 10 == 5, F.lit(None))
    station = hot.otherwise(F.concat(F.lit("S"), (F.col("id") % 997).cast("string")))
    stamp = F.timestamp_seconds(F.col("id") * 61)
    path = str(tmp_path / "readings")
    spark.range(120_000).select("id", station.alias("station_id"), stamp.alias("timestamp")).write.parquet(path)
    stations = [(s, f"p{n % 7}", f"r{n % 3}") for n, s in enumerate(["HOT", "WARM", *[f"S{i}" for i in range(900)]])]
    return spark.read.parquet(path), spark.createDataFrame(stations, "station_id string, province string, region string")


def test_only_heavy_stations_are_spread(spark, skewed):
    readings, stations = skewed
    heavy = {r.station_id: r.pieces for r in joins.heavy_keys(readings, "station_id", 0.05).collect()}
    assert set(heavy) == {"HOT", "WARM"} and heavy["HOT"] > heavy["WARM"] > 1
    joined = joins.enrich_left(readings, stations, strategy="skew")
    plain = readings.join(stations, "station_id", "left").select(joined.columns)
    assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spread = joins.enrich_left(readings, stations, strategy="skew")
        sizes = sorted(r["count"] for r in spread.groupBy(F.spark_partition_id()).count().collect())
        merged = joins.enrich_left(readings, stations, strategy="merge")
        worst = max(r["count"] for r in merged.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(sizes) == 16 and sizes[-1] <= 2 * sizes[8] and worst > 3 * sizes[-1]


def test_latest_day_opens_the_last_days_only(spark, tmp_path):
    rows = [(s, f"2026-04-{d:02d}", f"2026-04-{d:02d} {h:02d}:00", float(h)) for s, last in (("A", 9), ("B", 5)) for d in range(1, last + 1) for h in (3, 4)]
    df = spark.createDataFrame(rows, "station_id string, date string, timestamp string, v double")
    path = str(tmp_path / "hourly")
    tables.write_partitioned(df, path, "date")
    view = spark.read.schema(df.schema).parquet(path)
    day = latest.latest_day_of_view(view)
    assert sorted(map(repr, day.select(view.columns).collect())) == sorted(map(repr, latest.latest_day(view).collect()))
    assert "dynamicpruning" in plan_of(latest.latest_day_of_view(view))


def test_messages_fall_into_four_outcomes(spark):
    good = {"date": "2026-04-01", "timestamp": "2026-04-01 05:00:00", "station_id": "A", "pm25": 1.0}
    texts = {
        "reading": [json.dumps(good), json.dumps({**good, "pm25": None}), json.dumps({k: v for k, v in good.items() if k != "pm25"})],
        "missing": ["{}", json.dumps({k: v for k, v in good.items() if k != "station_id"})],
        "null": [json.dumps({**good, "station_id": None})],
        "broken": ["", "no json", json.dumps(good)[:-3], "[1]", json.dumps({**good, "pm25": "much"}), None],
    }
    feed = spark.createDataFrame([(t,) for group in texts.values() for t in group], "value string")
    got = {}
    for r in messages.message_outcomes(feed).collect():
        got.setdefault(r.outcome, []).append(r.value)
    assert got == texts
    assert messages.rejected_messages(feed, "missing", "null").count() == 3
    assert messages.rejected_messages(feed).count() == 9


def test_a_reader_never_sees_a_gap(spark, tmp_path):
    root, seen, stop = str(tmp_path), [], threading.Event()
    rows = spark.range(200).select(F.lit("A").alias("station_id"), F.col("id").cast("double").alias("avg_pm25"))
    tables.publish_view(rows.withColumn("n", F.lit(0)), root, "summary")

    def read():
        while not stop.is_set():
            found = tables.scan_view(spark, root, "summary").groupBy("n").count().collect()
            seen.append([(r.n, r["count"]) for r in found])

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for n in range(1, 6):
            tables.publish_view(rows.withColumn("n", F.lit(n)), root, "summary", keep=4)
    finally:
        stop.set()
        reader.join(60)
    assert seen and all(len(s) == 1 and s[0][1] == 200 for s in seen)
    assert [s[0][0] for s in seen] == sorted(s[0][0] for s in seen)
    # A publish that breaks leaves the view as it was.
    with pytest.raises(Exception, match="lost"):
        tables.publish_view(rows.withColumn("n", F.raise_error(F.lit("lost")).cast("int")), root, "summary")
    assert tables.scan_view(spark, root, "summary").first().n == 5
    tables.publish_view(rows.withColumn("n", F.lit(6)), root, "summary", keep=1, table="summary_by_name")
    assert spark.sql("SELECT max(n) AS n FROM summary_by_name").first().n == 6
    tables.publish_view(rows.withColumn("n", F.lit(7)), root, "summary", keep=1, table="summary_by_name")
    assert spark.sql("SELECT max(n) AS n FROM summary_by_name").first().n == 7
    spark.sql("DROP TABLE summary_by_name")


def test_a_running_stream_counts_its_batches(spark, tmp_path, stations):
    feed = tmp_path / "feed"
    feed.mkdir()
    for n, names in enumerate((["A", "B", "X"], ["A", "Y", "Y", "Y"])):
        lines = [json.dumps({"date": "2026-04-01", "timestamp": "2026-04-01 05:00:00", "station_id": s, "pm25": 1.0}) for s in names]
        (feed / f"{n}.txt").write_text("\n".join(lines) + "\n")
    readings = messages.decode_readings(messages.file_messages(spark, str(feed), max_files_per_trigger=1))
    counted = speed.counted_stream(readings, stations)
    assert "CollectMetrics" in counted._jdf.queryExecution().analyzed().toString()
    live = keyed.snapshot_table(str(tmp_path / "live"), schemas.REALTIME_VIEW)
    query = speed.start_latest(counted, live, str(tmp_path / "check"))
    speed.drain(query)
    counts = sorted((c["rows"], c["accepted"], c["rejected"]) for c in speed.batch_counts(query))
    assert counts == [(3, 2, 1), (4, 1, 3)]
    assert sorted(r.station_id for r in live.read(spark).collect()) == ["A", "B"]


def test_one_city(spark):
    realtime = spark.createDataFrame(
        [("A", "Alpha", "North", 200, "Unhealthy", 30.0, "Normal"), ("B", "Beta", "South", 170, "Unhealthy", 41.0, "Extreme Heat")],
        "station_id string, province string, region string, aqi_index int, aqi_alert string, temperature double, temp_alert string",
    ).withColumns({"timestamp": F.current_timestamp(), "pm25": F.lit(80.0)})
    registry = spark.createDataFrame([("A", 1, "Alpha", "North"), ("B", 2, "Beta", "South")], "station_id string, city_id int, province string, region string")
    summary = spark.createDataFrame([("A", 20.0, 10.0), ("B", 30.0, 20.0)], "station_id string, avg_temp double, avg_pm25 double")
    serving = Serving(realtime_rows=realtime, summary_rows=summary, registry=registry, snapshot=True)
    assert [r.city_name for r in serving.city_compare(2).collect()] == ["Beta"]
    assert sorted(r.alert_type for r in serving.city_alerts(city_id=2).collect()) == ["Heatwave", "Pollution Spike"]
    assert [r.alert_type for r in serving.city_alerts(city_id=1).collect()] == ["Pollution Spike"]
    assert serving.city_compare(9).count() == serving.city_alerts(city_id=9).count() == 0
    ordered = ranking.by_exceedance(serving.alerts()).collect()
    assert [r.ratio for r in ordered] == sorted((r.ratio for r in ordered), reverse=True)


@pytest.mark.parametrize("field,direction", [("v", "asc"), ("v", "desc"), ("s", "asc"), ("t", "desc"), ("hot", "desc"), ("hot", "asc")])
def test_ranks_without_a_table(spark, field, direction):
    rng = random.Random(6)
    values = [None, 0.5, -1.0, float("nan"), float("inf"), float("-inf"), 3.0]
    rows = [
        (f"S{i:04d}", rng.choice(values) if i % 3 else rng.random(), rng.choice(["", None, "Ha Noi", "Hue", "Huế", "zz", f"x{i}"]),
         f"2026-04-{i % 28 + 1:02d} 0{i % 9}:00:00", 7 if i % 3 else i)
        for i in range(500)
    ]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "station_id string, v double, s string, t string, hot int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    ranked = ranking.rank_by(df, field, direction, ranges=8)
    order = [r.station_id for r in df.orderBy(ranking.sort_key(field, direction), "station_id").collect()]
    got = {r.station_id: r["rank"] for r in ranked.collect()}
    assert [got[s] for s in order] == list(range(1, 501)) and ranked.columns == [*df.columns, "rank"]
    if field == "hot":  # a value of two thirds of the rows is dealt over several ranges
        plan = plan_of(ranked)
        assert "percentile_approx" in plan and "SinglePartition" in plan
    assert ranking.rank_by(df.limit(0), field, direction).count() == 0
