from __future__ import annotations

import os
import random
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.operators import projections
from aerolith.session import path_exists, run_dir, shared_dir
from aerolith.sinks import keyed, tables
from aerolith.sources import messages


def stored(df):
    return df.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


@pytest.fixture
def sample(readings):
    return readings(
        ("A", "2026-04-01 00:10", 10.0, 20.0, 50.0, 1.0),
        ("A", "2026-04-01 05:10", None, 22.5, 70.0, 3.0),
        ("B", "2026-04-02 23:59:07.25", 200.0, -3.5, None, 5.5),
    )


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert run_dir(spark, "x") != run_dir(spark, "x")


def test_partitioned_write_rebalances(spark, sample, stations, tmp_path, rows_of):
    path = str(tmp_path / "enriched")
    enriched = sample.join(stations, "station_id", "left")
    tables.write_enriched_lake(enriched, path)
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["region=North", "region=South"]
    back = spark.read.schema(enriched.schema).parquet(path).select(*enriched.columns)
    assert rows_of(back, "timestamp") == rows_of(enriched, "timestamp")
    hinted = enriched.hint("rebalance", F.col("region"), F.col("date"))
    assert "REBALANCE" in hinted._jdf.queryExecution().executedPlan().toString()


def test_messages_round_trip(spark, sample, rows_of):
    text = tables.to_message_json(sample)
    first = text.where(F.col("value").contains('"B"')).first().value
    assert first == (
        '{"date":"2026-04-02","timestamp":"2026-04-02 23:59:07.25","station_id":"B",'
        '"pm25":200.0,"temperature":-3.5,"no2":5.5}'
    )
    back = messages.decode_readings(text)
    assert rows_of(back, "timestamp") == rows_of(stored(sample).select(*schemas.READING.names), "timestamp")


def test_exported_csv(spark, sample, tmp_path):
    path = str(tmp_path / "out")
    tables.export_station_csv(sample, path)
    lines = sorted({r.value for r in spark.read.text(path).collect()})
    assert lines == [
        "A,2026-04-01 00:10:00,20.0,50.0,10.0,1.0",
        "A,2026-04-01 05:10:00,22.5,70.0,,3.0",
        "B,2026-04-02 23:59:07.25,-3.5,,200.0,5.5",
        "station_id,time,temp,rhum,pm25,no2",
    ]


def test_views_are_replaced_registered_and_dropped(spark, sample, tmp_path):
    root = str(tmp_path)
    tables.publish_view(sample, root, "daily")
    tables.publish_view(sample.limit(1), root, "daily")
    assert tables.scan_view(spark, root, "daily").count() == 1
    tables.register_view(spark, root, "daily", "daily_by_name")
    assert spark.sql("SELECT count(*) AS n FROM daily_by_name").first().n == 1
    assert tables.drop_views(spark, root, "daily", "hourly", tables=("daily_by_name", "never")) == ["daily"]
    assert not path_exists(spark, f"{root}/daily")
    assert not spark.catalog.tableExists("daily_by_name")
    with pytest.raises(ValueError):
        tables.scan_view(spark, root, "other")


def live(df, stations):
    return keyed.with_slot(projections.rate(stored(df).join(stations, "station_id")))


def test_snapshot_keeps_the_newest_reading(spark, readings, stations, tmp_path, rows_of):
    table = keyed.snapshot_table(str(tmp_path / "realtime"), schemas.REALTIME_VIEW)
    assert table.read(spark).count() == 0

    def seen():
        return rows_of(table.read(spark).select("station_id", "pm25"), "station_id")

    # The older of two rows of one station comes last within the batch.
    first = readings(
        ("A", "2026-04-01 06:00", 2.0, 1.0, 1.0, 1.0),
        ("A", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0),
        ("B", "2026-04-01 05:00", 3.0, 1.0, 1.0, 1.0),
    )
    table.upsert(live(first, stations), 0)
    assert seen() == [("A", 2.0), ("B", 3.0)]
    older = readings(("A", "2026-04-01 05:30", 9.0, 1.0, 1.0, 1.0))
    table.upsert(live(older, stations), 1)
    assert seen() == [("A", 2.0), ("B", 3.0)]
    newer = readings(("B", "2026-04-01 07:00", 4.0, 1.0, 1.0, 1.0), ("C", "2026-04-01 07:00", 5.0, 1.0, 1.0, 1.0))
    for batch_id in (2, 2, 3):
        table.upsert(live(newer, stations), batch_id)
        assert seen() == [("A", 2.0), ("B", 4.0), ("C", 5.0)]
    table.upsert(live(newer.limit(0), stations), 4)
    assert seen() == [("A", 2.0), ("B", 4.0), ("C", 5.0)]


def series(df, value):
    return stored(df).select(
        F.concat_ws("_", "station_id", F.date_format("timestamp", "HH")).alias("_id"),
        "date",
        F.lit(value).alias("v"),
    )


@pytest.fixture
def table(tmp_path):
    schema = schemas._struct([("_id", schemas._S), ("date", schemas._S), ("v", schemas._D)])
    return keyed.series_table(str(tmp_path / "hourly"), schema)


def day_files(table, day, writer="manual"):
    return sorted(os.listdir(f"{table.path}/{keyed.WRITER}={writer}/date={day}"))


def test_series_upserts_touch_their_days_only(spark, readings, table, rows_of):
    both = readings(("A", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0), ("A", "2026-04-02 05:00", 1.0, 1.0, 1.0, 1.0))
    table.upsert(series(both, 1.0), 0)
    untouched = day_files(table, "2026-04-01")
    later = readings(("A", "2026-04-02 05:00", 1.0, 1.0, 1.0, 1.0), ("A", "2026-04-02 06:00", 1.0, 1.0, 1.0, 1.0))
    table.upsert(series(later, 2.0), 1)
    assert day_files(table, "2026-04-01") == untouched
    wanted = [("2026-04-01", "A_05", 1.0), ("2026-04-02", "A_05", 2.0), ("2026-04-02", "A_06", 2.0)]
    assert rows_of(table.read(spark).select("date", "_id", "v"), "date", "_id") == wanted
    copy = replace(table, path=f"{table.path}-copy")
    table.copy_to(copy, spark)
    assert rows_of(copy.read(spark).select("date", "_id", "v"), "date", "_id") == wanted
    plan = table.read(spark).where("date = '2026-04-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_a_day_is_read_without_its_history(spark, readings, table, rows_of):
    """However many batches came: one scan without an aggregate, one row per key in the files."""
    for n in range(4):
        day = readings(*[(f"S{i}", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0) for i in range(6)])
        table.upsert(series(day, float(n)), n)
    plan = table.read(spark)._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Exchange" not in plan
    assert spark.read.parquet(table.path).count() == 6
    assert rows_of(table.read(spark).groupBy("v").count()) == [(3.0, 6)]


def test_a_replayed_batch_does_not_undo_newer_rows(spark, table, rows_of):
    def one(value):
        return spark.createDataFrame([("A", "d", value)], "_id string, date string, v double")

    table.upsert(one(1.0), 0, "stream")
    table.upsert(one(9.0), writer="fill")
    table.upsert(one(1.0), 0, "stream")
    assert rows_of(table.read(spark).select("v")) == [(9.0,)]
    table.upsert(one(2.0), 1, "stream")
    table.upsert(one(1.0), 0, "stream")
    assert rows_of(table.read(spark).select("v")) == [(2.0,)]


def test_traces_of_two_writers_with_replays_and_crashes(spark, tmp_path, monkeypatch):
    """Any trace leaves what a dictionary holds that applies each batch once, when it first comes."""
    schema = schemas._struct([("_id", schemas._S), ("date", schemas._S), ("v", schemas._D), ("w", schemas._D)])
    move = keyed.replace_path
    for seed in range(3):
        rng = random.Random(seed)
        table = keyed.series_table(str(tmp_path / f"trace{seed}"), schema)
        model, given = {}, {"a": [], "b": []}
        for _ in range(10):
            writer = rng.choice("ab")
            old = bool(given[writer]) and rng.random() < 0.4
            if old:
                number = rng.randrange(len(given[writer]))
            else:
                number = len(given[writer])
                names = rng.choice([["v"], ["w"], ["v", "w"]])
                keys = rng.sample([(k, d) for k in "ABC" for d in ("d1", "d2")], rng.randint(1, 4))
                given[writer].append((names, [(*key, *[rng.random() for _ in names]) for key in keys]))
            names, rows = given[writer][number]
            batch = spark.createDataFrame(rows, ", ".join(["_id string", "date string", *[f"{n} double" for n in names]]))
            if not old and rng.random() < 0.4:

                def lost(spark_, source, target):
                    """The driver is lost when an old partition is gone and the new one not yet there."""
                    shutil.rmtree(target.removeprefix("file:"), ignore_errors=True)
                    raise RuntimeError("driver lost")

                monkeypatch.setattr(keyed, "replace_path", lost)
                try:
                    table.upsert(batch, number, writer)
                except RuntimeError as error:
                    assert str(error) == "driver lost"
                monkeypatch.setattr(keyed, "replace_path", move)
            table.upsert(batch, number, writer)
            if not old:
                for key, day, *values in rows:
                    model.setdefault((key, day), {}).update(zip(names, values, strict=True))
            got = {(r._id, r.date): (r.v, r.w) for r in table.read(spark).collect()}
            assert got == {k: (m.get("v"), m.get("w")) for k, m in model.items()}


def test_a_crash_costs_no_other_batch(spark, readings, table, rows_of):
    day = readings(("A", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0), ("B", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0))
    table.upsert(series(day, 1.0), 0)

    def torn(value):
        return series(day, value).withColumn("v", F.when(F.col("_id") == "B_05", F.raise_error(F.lit("lost"))).otherwise(F.lit(value)))

    with pytest.raises(Exception, match="lost"):
        table.upsert(torn(2.0), 1)
    assert rows_of(table.read(spark).select("_id", "v"), "_id") == [("A_05", 1.0), ("B_05", 1.0)]
    # Another day's batch goes ahead, and the torn one can be given again, more than once.
    other = readings(("A", "2026-04-02 05:00", 1.0, 1.0, 1.0, 1.0))
    table.upsert(series(other, 3.0), 2)
    for _ in range(2):
        table.upsert(series(day, 2.0), 1)
        got = rows_of(table.read(spark).select("date", "_id", "v"), "date", "_id")
        assert got == [("2026-04-01", "A_05", 2.0), ("2026-04-01", "B_05", 2.0), ("2026-04-02", "A_05", 3.0)]


def test_two_writers_on_one_day_and_absent_columns(spark, tmp_path, rows_of):
    schema = schemas._struct([("_id", schemas._S), ("date", schemas._S), ("v", schemas._D), ("w", schemas._D)])
    table = keyed.series_table(str(tmp_path / "two"), schema)

    def rows(*values, names):
        return spark.createDataFrame(list(values), f"_id string, date string, {names}")

    table.upsert(rows(("A", "d", 1.0, 10.0), ("B", "d", 2.0, 20.0), names="v double, w double"), 0, writer="stream")
    table.upsert(rows(("A", "d", 5.0), ("C", "d", 6.0), names="w double"), writer="fill")
    table.upsert(rows(("B", "d", None), names="v double"), writer="fill")
    wanted = [("A", 1.0, 5.0), ("B", None, 20.0), ("C", None, 6.0)]
    assert rows_of(table.read(spark).select("_id", "v", "w"), "_id") == wanted
    with pytest.raises(ValueError, match="date"):
        table.upsert(rows(("A", "d", 5.0), names="w double").drop("date"))


def test_large_partitions_are_written_by_several_tasks(spark, readings, table, rows_of):
    small = replace(table, spread=3)
    day = readings(*[(f"S{i}", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0) for i in range(12)])
    # As in a stream's batches, where no adaptive step joins small partitions.
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        small.upsert(series(day, 1.0), 0)
        small.upsert(series(day, 2.0), 1)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = [f for f in day_files(table, "2026-04-01") if f.endswith(".parquet")]
    assert len(files) > 1
    assert rows_of(table.read(spark).groupBy("v").count()) == [(2.0, 12)]
