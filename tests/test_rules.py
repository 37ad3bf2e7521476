from __future__ import annotations

import math
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from aerolith.functions import (
    alert_display,
    aqi_alert,
    aqi_category,
    deviation,
    deviation_display,
    exceedance,
    half_away,
    half_even,
    half_up,
    heat_index,
    is_anomaly,
    is_benign,
    mean,
    pm25_to_aqi,
    register_sql_functions,
    temp_alert,
    weather_condition,
)
from aerolith.functions import rules


def one_column(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def apply(spark, values, column, kind="double"):
    rows = one_column(spark, values, kind).select("i", column.alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def test_index_at_segment_bounds(spark):
    expected = {
        0.0: 0,
        6.0: 25,
        12.0: 50,
        12.05: 51,
        12.1: 51,
        35.4: 100,
        35.45: 101,
        35.5: 101,
        55.4: 150,
        55.5: 151,
        150.4: 200,
        150.5: 201,
        250.4: 300,
        250.5: 301,
        350.4: 400,
        350.5: 401,
        500.4: 500,
        500.41: 500,
        1e6: 500,
        -1.0: -4,
        float("nan"): 500,
        None: 0,
    }
    assert apply(spark, list(expected), pm25_to_aqi("x")) == list(expected.values())


def test_index_null_policy(spark):
    assert apply(spark, [None, 12.0], pm25_to_aqi("x", "null")) == [None, 50]
    with pytest.raises(ValueError):
        pm25_to_aqi("x", "other")


def test_index_of_absurd_value_does_not_fail_the_job(spark):
    assert apply(spark, [-1e300], pm25_to_aqi("x")) == [None]


def test_alert_bands(spark):
    values = [-5, 50, 51, 100, 101, 150, 151, 200, 201, 300, 301, None]
    labels = apply(spark, values, aqi_alert("x"), "int")
    assert labels == [
        "Good",
        "Good",
        "Moderate",
        "Moderate",
        "Unhealthy for Sensitive Groups",
        "Unhealthy for Sensitive Groups",
        "Unhealthy",
        "Unhealthy",
        "Very Unhealthy",
        "Very Unhealthy",
        "Hazardous",
        None,
    ]
    short = apply(spark, values, aqi_category("x"), "int")
    assert short[4] == "Unhealthy (SG)" and short[-1] is None
    assert apply(spark, [None], aqi_alert("x", "fallthrough"), "int") == ["Hazardous"]


def test_temperature_bands(spark):
    values = [9.99, 10.0, 35.0, 35.01, 40.0, 40.01, None]
    assert apply(spark, values, temp_alert("x")) == [
        "Too Cold",
        "Normal",
        "Normal",
        "Hot",
        "Hot",
        "Extreme Heat",
        None,
    ]
    assert apply(spark, [None], temp_alert("x", "fallthrough")) == ["Extreme Heat"]
    assert apply(spark, [None], temp_alert("x", "normal")) == ["Normal"]


def test_rounding_rules_differ_on_ties(spark):
    values = [-24.5, 24.5, 2.5, 0.125, 1.005, None]
    assert apply(spark, values, half_up("x", 0)) == [-24.0, 25.0, 3.0, 0.0, 1.0, None]
    assert apply(spark, values, half_away("x", 0)) == [-25.0, 25.0, 3.0, 0.0, 1.0, None]
    assert apply(spark, values, half_even("x", 0)) == [-24.0, 24.0, 2.0, 0.0, 1.0, None]
    assert apply(spark, [0.125, 1.005], half_away("x", 2)) == [0.13, 1.01]
    assert apply(spark, [0.125, 1.005], half_up("x", 2)) == [0.13, 1.0]
    assert apply(spark, [0.125], half_even("x", 2)) == [0.12]


def test_heat_index_and_condition(spark):
    df = spark.createDataFrame(
        [(30.0, 80.0, 10.0), (None, 80.0, 10.0), (36.0, None, 150.0), (36.0, 1.0, 150.1), (1.0, 1.0, None)],
        "t double, h double, p double",
    )
    got = df.select(heat_index("t", "h"), weather_condition("p", "t")).collect()
    assert [tuple(r) for r in got] == [
        (34.0, "Normal"),
        (None, "Normal"),
        (None, "Extreme Heat"),
        (36.1, "Hazardous"),
        (1.1, "Normal"),
    ]


def test_flags(spark):
    df = spark.createDataFrame(
        [("Good", "Hot"), ("Good", "Too Cold"), ("Hazardous", None), (None, None)], "a string, t string"
    )
    got = df.select(is_anomaly("a", "t"), is_benign("a"), is_benign("t")).collect()
    assert [tuple(r) for r in got] == [
        (False, True, False),
        (True, True, False),
        (True, False, False),
        (False, False, False),
    ]


def test_alert_display_and_exceedance(spark):
    df = spark.createDataFrame(
        [
            ("Air Quality", "Hazardous", 301.0),
            ("Air Quality", "Unhealthy", 160.0),
            ("Temperature", "Too Cold", 5.0),
        ],
        "alert_type string, level string, value double",
    )
    shown, threshold = alert_display()
    ratio, percent = exceedance("value", "threshold")
    got = df.withColumn("threshold", threshold).select(shown, "threshold", percent, ratio > 1).collect()
    assert [tuple(r) for r in got] == [
        ("AQI Hazardous", 150, 201, True),
        ("Pollution Spike", 150, 107, True),
        ("Heatwave", 35, 14, False),
    ]


def test_deviation_display(spark):
    df = spark.createDataFrame(
        [(30.0, 20.0), (10.0, 20.0), (20.0, 20.0), (20.0, None), (20.0, 0.0), (90.0, 20.0), (None, 20.0)],
        "c double, b double",
    )
    direction, worse, ratio = deviation_display("c", "b", rules.deviation_sql("c", "b", 1))
    lower_is_worse = deviation_display("c", "b", rules.deviation_sql("c", "b", 1), False)[1]
    got = df.select(deviation("c", "b", 1), direction, worse, ratio, lower_is_worse).collect()
    assert [tuple(r) for r in got] == [
        (10.0, "↑", True, 1.5, False),
        (-10.0, "↓", False, 0.5, True),
        (0.0, "→", False, 1.0, False),
        (None, "↓", False, 1.0, True),
        (20.0, "↑", True, 1.0, False),
        (70.0, "↑", True, 1.5, False),
        (None, "↓", False, 0.0, True),
    ]


def test_named_functions_are_inlined(spark):
    register_sql_functions(spark)
    df = spark.sql(
        "SELECT pm25ToAQI(p) AS aqi, calculateHeatIndex(p, 80D) AS heat FROM VALUES (12.0D), (NULL) AS v(p)"
    )
    assert [tuple(r) for r in df.collect()] == [(50, 16.0), (0, None)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "pm25ToAQI" not in plan


def _exact(values, digits, ties):
    total = sum(Decimal(str(v)) for v in values) / len(values)
    step = Decimal(1).scaleb(-digits)
    if ties == "up":
        return float(math.floor(total / step + Decimal("0.5")) * step)
    return float(total.quantize(step, ROUND_HALF_EVEN if ties == "even" else ROUND_HALF_UP))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.integers(-20000, 60000).map(lambda c: c / 100), min_size=1, max_size=8),
        min_size=1,
        max_size=20,
    )
)
def test_fixed_mean_is_the_exact_mean(spark, groups):
    data = [(g, v) for g, values in enumerate(groups) for v in values]
    df = spark.createDataFrame(data, "g int, x double")
    cases = [(d, t) for d in (0, 1, 2) for t in ("away", "up", "even")]
    got = df.groupBy("g").agg(*[mean("x", d, "fixed", ties=t).alias(f"{t}{d}") for d, t in cases])
    for row in got.collect():
        for d, t in cases:
            # Decimal division is rounded at 28 digits; small denominators keep it exact enough.
            assert row[f"{t}{d}"] == pytest.approx(_exact(groups[row.g], d, t), abs=1e-12)


def test_mean_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    got = df.agg(mean("x", 1, "fixed"), mean("x", 1), mean("x", 1, "fixed", ties="even")).first()
    assert tuple(got) == (None, None, None)


def test_composed_timestamps(spark):
    df = spark.createDataFrame([("2026-06-01", 7), ("2026-06-01", 13)], "d string, h int")
    got = df.select(rules.compose_timestamp("d", "h").cast("string").alias("t")).collect()
    assert [r.t for r in got] == ["2026-06-01 07:00:00", "2026-06-01 13:00:00"]
