"""Messages of the live feed and the payloads they are made from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith import schemas
from aerolith.operators.projections import rename

WEATHER_NAMES = {"temperature_2m": "temperature", "relative_humidity_2m": "humidity"}
AIR_NAMES = {"pm2_5": "pm25", "nitrogen_dioxide": "no2"}
REQUIRED = ("station_id", "timestamp", "date")
BROKEN = "_broken"


def kafka_messages(
    spark: SparkSession, servers: str, topic: str, starting_offsets: str = "latest", **options: str
) -> DataFrame:
    """Text values of a Kafka topic (the connector package must be on the class path)."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .options(**options)
    )
    return reader.load().select(F.col("value").cast("string").alias("value"))


def file_messages(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same text values from files with one message per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def decode_readings(messages: DataFrame) -> DataFrame:
    """JSON messages as readings. Text that is no JSON gives a row of nulls, a bad field a null."""
    parsed = F.from_json(F.col("value").cast("string"), schemas.READING)
    return messages.select(parsed.alias("data")).select("data.*")


def valid_readings(decoded: DataFrame) -> DataFrame:
    """Rows that can be filed: with a station, an instant and a day."""
    return decoded.where(_fileable())


def quarantined(messages: DataFrame) -> DataFrame:
    """The text of the messages ``valid_readings`` leaves out."""
    parsed = F.from_json(F.col("value").cast("string"), schemas.READING)
    return messages.select("value", parsed.alias("data")).where(~_fileable("data.")).select("value")


def _fileable(prefix: str = "") -> Column:
    return (
        F.col(f"{prefix}station_id").isNotNull()
        & F.col(f"{prefix}timestamp").isNotNull()
        & F.col(f"{prefix}date").isNotNull()
    )


def message_outcomes(messages: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """Messages with their reading's fields and ``outcome``, told apart in one pass.

    ``broken``: text that is no JSON object, or a field of the wrong kind; ``missing``: an object that lacks a
    required field; ``null``: a required field that is there and null; ``reading``: all else.
    """
    schema = T.StructType([*schemas.READING.fields, T.StructField(BROKEN, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    text = F.col("value").cast("string")
    parsed = messages.select(
        "value", F.json_object_keys(text).alias("_keys"), F.from_json(text, schema, options).alias("data")
    )
    lacks = F.size(F.array_except(F.array(*[F.lit(c) for c in required]), "_keys")) > 0
    empty = reduce(Column.__or__, [F.col(f"data.{c}").isNull() for c in required])
    outcome = (
        F.when(F.col("_keys").isNull() | F.col(f"data.{BROKEN}").isNotNull(), "broken")
        .when(lacks, "missing")
        .when(empty, "null")
        .otherwise("reading")
    )
    return parsed.select("value", outcome.alias("outcome"), *[F.col(f"data.{c}").alias(c) for c in schemas.READING.names])


def rejected_messages(messages: DataFrame, *outcomes: str) -> DataFrame:
    """The text of messages with one of the ``outcomes`` (all but readings if none is named), for the quarantine."""
    told = message_outcomes(messages)
    wanted = F.col("outcome").isin(*outcomes) if outcomes else F.col("outcome") != "reading"
    return told.where(wanted).select("value")


def _observed(payloads: DataFrame, payload: str) -> DataFrame:
    parsed = payloads.withColumn("_p", F.from_json(payload, schemas.OBSERVATION_PAYLOAD))
    return parsed.withColumn(
        "_whole",
        F.expr(
            "coalesce(try_cast(_p.current.temp_c AS DOUBLE) IS NOT NULL"
            " AND try_cast(_p.current.humidity AS DOUBLE) IS NOT NULL"
            " AND _p.current.air_quality IS NOT NULL, false)"
        ),
    )


def flatten_observation(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Nested observation JSON to flat measures.

    Temperature and humidity must be there (with the air-quality object); a missing pollutant
    counts as 0.0. Other columns pass through.
    """
    others = [c for c in payloads.columns if c != payload]
    return (
        _observed(payloads, payload)
        .where("_whole")
        .selectExpr(
            *others,
            "coalesce(try_cast(_p.current.air_quality.pm2_5 AS DOUBLE), 0D) AS pm25",
            "try_cast(_p.current.temp_c AS DOUBLE) AS temperature",
            "try_cast(_p.current.humidity AS DOUBLE) AS humidity",
            "coalesce(try_cast(_p.current.air_quality.no2 AS DOUBLE), 0D) AS no2",
        )
    )


def rejected_observations(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """The payloads ``flatten_observation`` leaves out."""
    return _observed(payloads, payload).where("NOT _whole").select(*payloads.columns)


def explode_hourly(
    payloads: DataFrame, payload: str, names: dict[str, str], position: str | None = None
) -> DataFrame:
    """Parallel hourly arrays to one row per array position, beside the payload's other columns.

    ``names`` maps the arrays wanted (next to ``time``) to their reading columns. A shorter
    array gives nulls. ``position`` names a column for the place in the arrays, if wanted.
    """
    others = [c for c in payloads.columns if c != payload]
    arrays = F.arrays_zip(*[F.col(payload)[a].alias(a) for a in ("time", *names)])
    if position is None:
        return rename(payloads.select(*others, F.inline(arrays)), names)
    placed = payloads.select(*others, F.posexplode(arrays).alias(position, "_hour"))
    return rename(placed.select(*others, position, "_hour.*"), names)


def parse_delimited(messages: DataFrame) -> DataFrame:
    """Comma-separated positional messages: time, id, count, -, high, low, -, -, vwap."""
    # Position of each field.
    positions = {"time": 0, "id": 1, "count": 2, "high": 4, "low": 5, "vwap": 8}
    words = messages.select(F.split(F.trim("value"), r",\s*").alias("w"))
    return words.select(
        *[
            F.get("w", F.lit(positions[f.name])).try_cast(f.dataType).alias(f.name)
            for f in schemas.DELIMITED_MESSAGE
        ]
    )
