"""Every registered query against its oracle on the smallest driver data."""

from __future__ import annotations

import os
from functools import cache

import pytest

import __spark_entry__ as driver
from aerolith.driver.catalog import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")
DATA = driver.SMOKE_DIR
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver data not present")


@cache
def _oracle():
    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    answer = _oracle().execute(ORACLES[name])
    names = [d[0] for d in answer.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(row[i] for i in order)) for row in answer.fetchall())


# Queries whose rows come in an order, and that order as the oracle's own.
ORDERED = {
    "t1_ordered_daily": "date, region, province, station_id",
    "t4_sorted_table": "pm25 DESC NULLS LAST, station_id",
    "q1_realtime": "station_id",
    "q2_realtime_series": "station_id, timestamp",
    "q2_series_of_station": "timestamp",
    "q3_hourly": "station_id, timestamp",
    "q3_published_hourly": "station_id, timestamp",
    "q4_daily": "station_id, date",
    "q5_provinces": "region, province, station_id",
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_rows_come_in_order(spark, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = [repr(tuple(r)) for r in df.select(*columns).collect()]
    answer = _oracle().execute(f"SELECT {', '.join(columns)} FROM ({ORACLES[name]}) ORDER BY {ORDERED[name]}")
    assert got == [repr(tuple(r)) for r in answer.fetchall()]
