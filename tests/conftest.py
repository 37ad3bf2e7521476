from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from aerolith.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    def collect(df, *order):
        picked = df.orderBy(*order) if order else df
        return [tuple(r) for r in picked.collect()]

    return collect


READING_TYPES = (
    "station_id string, timestamp timestamp_ntz, date string, pm25 double, temperature double, "
    "humidity double, no2 double"
)


@pytest.fixture
def readings(spark):
    """Readings from (station, 'yyyy-MM-dd HH:mm[:ss]', pm25, temperature, humidity, no2) tuples."""

    def make(*rows):
        data = [(s, t, p, c, h, n) for s, t, p, c, h, n in rows]
        df = spark.createDataFrame(
            data, "station_id string, t string, pm25 double, temperature double, humidity double, no2 double"
        )
        return df.selectExpr(
            "station_id",
            "cast(t as timestamp_ntz) as timestamp",
            "substring(t, 1, 10) as date",
            "pm25",
            "temperature",
            "humidity",
            "no2",
        )

    return make


@pytest.fixture
def stations(spark):
    return spark.createDataFrame(
        [("A", "Alpha", "North"), ("B", "Beta", "South"), ("C", "Gamma", "South")],
        "station_id string, province string, region string",
    )
