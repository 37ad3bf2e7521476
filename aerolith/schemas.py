"""Declared schemas. Production reads never infer types."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in spec])


_S, _D, _TS, _I, _L = T.StringType(), T.DoubleType(), T.TimestampType(), T.IntegerType(), T.LongType()

MEASURES = ("pm25", "temperature", "humidity", "no2")

READING = _struct(
    [
        ("date", _S),
        ("timestamp", _TS),
        ("station_id", _S),
        ("pm25", _D),
        ("temperature", _D),
        ("humidity", _D),
        ("no2", _D),
    ]
)

STATION = _struct([("station_id", _S), ("province", _S), ("region", _S)])

# Optional columns some station files carry next to the required three.
STATION_EXTRAS = _struct([("station_name", _S), ("latitude", _D), ("longitude", _D)])

REGISTRY = _struct([("station_id", _S), ("city_id", _I), ("province", _S), ("region", _S)])

# Numbers are taken as text first: some feeds quote them.
OBSERVATION_PAYLOAD = _struct(
    [
        (
            "current",
            _struct(
                [
                    ("temp_c", _S),
                    ("humidity", _S),
                    ("air_quality", _struct([("pm2_5", _S), ("no2", _S)])),
                ]
            ),
        )
    ]
)

WEATHER_ARRAYS = _struct(
    [
        ("time", T.ArrayType(_S)),
        ("temperature_2m", T.ArrayType(_D)),
        ("relative_humidity_2m", T.ArrayType(_D)),
    ]
)
AIR_ARRAYS = _struct(
    [
        ("time", T.ArrayType(_S)),
        ("pm2_5", T.ArrayType(_D)),
        ("nitrogen_dioxide", T.ArrayType(_D)),
    ]
)

DELIMITED_MESSAGE = _struct(
    [("time", _L), ("id", _L), ("count", _D), ("high", _D), ("low", _D), ("vwap", _D)]
)

_GEO = [("province", _S), ("region", _S)]

REALTIME_VIEW = _struct(
    [("station_id", _S), *_GEO, ("date", _S), ("timestamp", _TS)]
    + [(m, _D) for m in MEASURES]
    + [("aqi_index", _I), ("aqi_alert", _S), ("temp_alert", _S)]
)

HOURLY_VIEW = _struct(
    [("station_id", _S), *_GEO, ("date", _S), ("timestamp", _TS), ("hour_end", _TS)]
    + [(f"{f}_{m}", _D) for m in ("pm25", "temp", "humidity") for f in ("avg", "max", "min")]
    + [("avg_no2", _D), ("avg_aqi", _D), ("max_aqi", _I)]
    + [(m, _D) for m in MEASURES]
    + [("aqi_index", _D), ("aqi_alert", _S), ("temp_alert", _S)]
)

DAILY_VIEW = _struct(
    [("date", _S), ("station_id", _S), *_GEO]
    + [(c, _D) for c in ("avg_temp", "max_temp", "min_temp", "avg_humidity", "avg_pm25", "avg_no2", "avg_aqi")]
    + [("peak_aqi_hour", _I), ("record_count", _L)]
)

SUMMARY_VIEW = _struct(
    [("station_id", _S), *_GEO]
    + [(c, _D) for c in ("avg_temp", "max_temp", "avg_humidity", "avg_pm25", "avg_no2")]
    + [("record_count", _L)]
)

VIEWS = {"realtime": REALTIME_VIEW, "hourly": HOURLY_VIEW, "daily": DAILY_VIEW, "summary": SUMMARY_VIEW}
