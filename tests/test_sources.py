from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.operators import filters
from aerolith.sources import lake, messages, registry


def write(path, text, encoding="utf-8"):
    path.write_text(text, encoding=encoding, newline="")
    return str(path)


def test_history_csv_by_column_name(spark, tmp_path, rows_of):
    path = write(
        tmp_path / "h.csv",
        "no2,station_id,time,temp,rhum,pm25\n1.5,A,2026-04-01 05:00:00,20,50,12.5\n,A,bad,x,,\n",
    )
    df = lake.scan_history_csv(spark, path)
    assert df.columns == schemas.READING.names
    got = rows_of(df.withColumn("timestamp", F.col("timestamp").cast("string")), F.col("pm25").desc())
    assert got == [
        ("2026-04-01", "2026-04-01 05:00:00", "A", 12.5, 20.0, 50.0, 1.5),
        (None, None, "A", None, None, None, None),
    ]


def test_single_site_export_with_byte_order_mark(spark, tmp_path):
    path = write(
        tmp_path / "e.csv",
        "time,temp,dwpt,rhum,prcp,snow,wdir,wspd,wpgt,pres,tsun,coco\n"
        "2026-03-27 00:00:00,25,23.1,89,0,,110,17,,1009,,2\n",
        encoding="utf-8-sig",
    )
    row = lake.scan_history_csv(spark, path).first()
    assert (row.date, row.temperature, row.humidity) == ("2026-03-27", 25.0, 89.0)
    assert (row.station_id, row.pm25, row.no2) == (None, None, None)


def test_history_without_required_column(spark, tmp_path):
    with pytest.raises(ValueError, match="rhum"):
        lake.scan_history_csv(spark, write(tmp_path / "x.csv", "time,temp\n2026-01-01,1\n"))


def test_station_files(spark, tmp_path, rows_of):
    plain = write(tmp_path / "s3.csv", "station_id,province,region\n HN01 , Ha Noi ,North\n")
    assert rows_of(registry.scan_stations(spark, plain)) == [("HN01", "Ha Noi", "North")]
    wide = write(
        tmp_path / "s6.csv",
        "station_id,station_name,province,region,latitude,longitude\r\nHN01,Lang,Ha Noi,North,21.0167,105.8167\r\n",
    )
    assert rows_of(registry.scan_stations(spark, wide)) == [
        ("HN01", "Ha Noi", "North", "Lang", 21.0167, 105.8167)
    ]
    with pytest.raises(ValueError, match="region"):
        registry.scan_stations(spark, write(tmp_path / "bad.csv", "station_id,province\nA,B\n"))


def test_registry(spark):
    df = registry.station_registry(spark)
    counts = {r.region: r["count"] for r in df.groupBy("region").count().collect()}
    assert counts == {"North": 15, "Central": 11, "South": 8}
    ids = {r.station_id: r.city_id for r in df.collect()}
    assert len(ids) == 34 and ids["HN01"] == 101 and ids["DN02"] == 128 and ids["AG01"] == 134


@pytest.fixture
def landed(spark, tmp_path, readings):
    path = str(tmp_path / "lake")
    df = readings(
        ("A", "2026-04-01 05:00", 1.0, 1.0, 1.0, 1.0),
        ("A", "2026-04-02 05:00", 2.0, 1.0, 1.0, 1.0),
        ("A", "2026-04-03 05:00", 3.0, 1.0, 1.0, 1.0),
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    df.write.partitionBy("date").parquet(path)
    return path


def test_lake_scan_prunes_and_keeps_day_strings(spark, landed, rows_of):
    df = lake.scan_lake(spark, landed, "2026-04-02", "2026-04-03")
    assert df.columns == schemas.READING.names
    assert rows_of(df.select("date", "pm25"), "pm25") == [("2026-04-02", 2.0), ("2026-04-03", 3.0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert dict(df.dtypes)["date"] == "string"


def test_range_on_instants_reaches_the_file_scan(spark, landed):
    df = filters.date_range(lake.scan_lake(spark, landed), "2026-04-02", "2026-04-02", "timestamp")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThan(timestamp" in plan


def test_master_combinations(spark, landed, tmp_path, rows_of):
    history = write(
        tmp_path / "h.csv",
        "time,temp,rhum\n2026-01-01 05:00:00,20,50\n2026-04-02 07:00:00,21,51\n",
    )

    def days(df):
        return [r[0] for r in rows_of(df.select("date"), "date")]

    window = ("2026-04-02", "2026-04-30")
    both = lake.load_master(spark, history, landed, None, *window)
    assert days(both) == ["2026-01-01", "2026-04-02", "2026-04-02", "2026-04-03"]
    narrowed = lake.load_master(spark, history, landed, None, *window, window_history=True)
    assert days(narrowed) == ["2026-04-02", "2026-04-02", "2026-04-03"]
    absent = str(tmp_path / "absent")
    assert days(lake.load_master(spark, absent, landed, None, *window)) == ["2026-04-02", "2026-04-03"]
    assert len(days(lake.load_master(spark, history, absent))) == 2
    assert len(days(lake.load_master(spark, None, None, history))) == 2
    with pytest.raises(FileNotFoundError):
        lake.load_master(spark, absent, absent, absent)


def test_decoding_keeps_malformed_rows_and_quarantine_takes_them(spark, rows_of):
    good = (
        '{"date":"2026-04-03","timestamp":"2026-04-03 10:00:00.5","station_id":"A",'
        '"pm25":1.5,"temperature":20,"humidity":50,"no2":2}'
    )
    wrong_type = good.replace("1.5", '"much"')
    bad_time = good.replace("2026-04-03 10:00:00.5", "noon")
    no_station = good.replace('"station_id":"A",', "")
    text = ["not json", good, wrong_type, bad_time, no_station, None]
    raw = spark.createDataFrame([(t,) for t in text], "value string")
    decoded = messages.decode_readings(raw)
    assert decoded.count() == 6
    assert decoded.where("station_id is null and pm25 is null and timestamp is null").count() == 2
    valid = messages.valid_readings(decoded)
    assert rows_of(valid.select(F.col("timestamp").cast("string"), "pm25"), "pm25") == [
        ("2026-04-03 10:00:00.5", None),
        ("2026-04-03 10:00:00.5", 1.5),
    ]
    held = {r.value for r in messages.quarantined(raw).collect()}
    assert held == {"not json", bad_time, no_station, None}
    as_bytes = raw.select(F.col("value").cast("binary").alias("value"))
    assert messages.valid_readings(messages.decode_readings(as_bytes)).count() == 2


def test_observations(spark, rows_of):
    text = [
        ("full", '{"current":{"temp_c":30.5,"humidity":70,"air_quality":{"pm2_5":12.5,"no2":3}}}'),
        ("quoted", '{"current":{"temp_c":"31","humidity":"71","air_quality":{"pm2_5":"2.5","no2":"?"}}}'),
        ("no pollutants", '{"current":{"temp_c":30,"humidity":70,"air_quality":{}}}'),
        ("wordy", '{"current":{"temp_c":"warm","humidity":70,"air_quality":{}}}'),
        ("no temperature", '{"current":{"humidity":70,"air_quality":{"pm2_5":1}}}'),
        ("no humidity", '{"current":{"temp_c":30,"air_quality":{"pm2_5":1}}}'),
        ("no air", '{"current":{"temp_c":30,"humidity":70}}'),
        ("no current", "{}"),
        ("not json", "<html>"),
    ]
    payloads = spark.createDataFrame(text, "station_id string, payload string")
    flat = messages.flatten_observation(payloads)
    assert rows_of(flat, "station_id") == [("full", 12.5, 30.5, 70.0, 3.0), ("no pollutants", 0.0, 30.0, 70.0, 0.0), ("quoted", 2.5, 31.0, 71.0, 0.0)]
    assert messages.rejected_observations(payloads).count() == 6


def test_hourly_arrays_of_unequal_length(spark, rows_of):
    schema = schemas.WEATHER_ARRAYS.simpleString()
    df = spark.createDataFrame([("A", (["t1", "t2"], [1.0, 2.0], [5.0])), ("B", None)], f"station_id string, weather {schema}")
    got = messages.explode_hourly(df, "weather", messages.WEATHER_NAMES)
    assert got.columns == ["station_id", "time", "temperature", "humidity"]
    assert rows_of(got, "time") == [("A", "t1", 1.0, 5.0), ("A", "t2", 2.0, None)]


def test_delimited_messages(spark, rows_of):
    text = ["1700000000000, 101, 1.0, 0, 55.5, 45.5, 0, 0, 50.25", "x,y", ""]
    df = messages.parse_delimited(spark.createDataFrame([(t,) for t in text], "value string"))
    got = rows_of(df, F.col("time").desc())
    assert got[0] == (1700000000000, 101, 1.0, 55.5, 45.5, 50.25)
    assert got[1] == got[2] == (None,) * 6


def test_history_files_with_another_column_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("station_id,time,temp,rhum,pm25,no2\nA,2026-01-01 00:00:00,1,2,3,4\n")
    (tmp_path / "b.csv").write_text("station_id,time,pm25,no2,temp,rhum\nA,2026-01-01 01:00:00,99,4,21,2\n")
    with pytest.raises(Exception, match="header"):
        lake.scan_history_csv(spark, str(tmp_path)).collect()
