"""Streaming jobs: landing the feed, the live snapshot and the hourly series."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from aerolith.functions import rules
from aerolith.operators import projections, rollups
from aerolith.operators.joins import enrich_inner
from aerolith.sinks.keyed import KeyedTable, with_slot

_LOG = logging.getLogger(__name__)
WATERMARK = "10 minutes"
TRIGGER = "1 minute"
BATCH_COUNTS = "batch_counts"


@contextmanager
def state_settings(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Settings for queries started inside: state in RocksDB, spread over ``partitions``.

    A query keeps the number of its first run in its checkpoint; choose it for the keys to come.
    """
    state_store = "spark.sql.streaming.stateStore"
    wanted = {
        "spark.sql.shuffle.partitions": str(partitions),
        f"{state_store}.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        f"{state_store}.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def _triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """Processing-time trigger, or everything available now when no interval is given."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def land_stream(
    readings: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER
) -> StreamingQuery:
    """Append readings to the date-partitioned lake; a map-only plan, exactly once by the file sink."""
    writer = (
        readings.writeStream.format("parquet")
        .outputMode("append")
        .partitionBy("date")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def quarantine_stream(
    rejected: DataFrame, path: str, checkpoint: str, interval: str | None = TRIGGER
) -> StreamingQuery:
    """Append the text of messages that could not be filed."""
    writer = (
        rejected.writeStream.format("text")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def send_stream(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, interval: str | None = TRIGGER
) -> StreamingQuery:
    """Unkeyed messages to a Kafka topic (connector package required)."""
    writer = (
        messages.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def each_batch(
    stream: DataFrame,
    apply: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    interval: str | None = TRIGGER,
) -> StreamingQuery:
    """Run ``apply(batch, batch_id)`` on every batch that has rows."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            apply(batch, batch_id)

    writer = (
        stream.writeStream.outputMode(mode).foreachBatch(run).option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def counted_stream(readings: DataFrame, stations: DataFrame, name: str = BATCH_COUNTS) -> DataFrame:
    """``rated_stream`` that also counts, in the same pass, the rows of each batch: all, of known and of unknown stations.

    The counts are metrics of the running query (``observe``): no second job and no second read of the batch.
    """
    known = stations.withColumn("_known", F.lit(True))
    marked = readings.join(known, "station_id", "left")
    accepted = F.count_if(F.col("_known").isNotNull())
    counted = marked.observe(
        name,
        F.count(F.lit(1)).alias("rows"),
        accepted.alias("accepted"),
        F.count_if(F.col("_known").isNull()).alias("rejected"),
    )
    return projections.rate(counted.where(F.col("_known")).drop("_known"))


def batch_counts(query: StreamingQuery, name: str = BATCH_COUNTS) -> list[dict[str, int]]:
    """The counts of the latest batches of a query over ``counted_stream``, one entry per batch that had rows.

    Spark keeps as many as ``spark.sql.streaming.numRecentProgressUpdates`` says (100).
    """
    found = {}
    for progress in query.recentProgress:
        counts = progress.observedMetrics.get(name)
        if counts is not None and counts["rows"]:
            found[progress.batchId] = {"batch": progress.batchId, **counts.asDict()}
    return [found[batch] for batch in sorted(found)]


def _upsert_into(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    def apply(batch: DataFrame, batch_id: int) -> None:
        # An empty batch ends in the upsert itself, after the one pass that finds its partitions.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        table.upsert(batch, batch_id, query or "manual")

    return apply


def rated_stream(readings: DataFrame, stations: DataFrame) -> DataFrame:
    """Readings of known stations with index and alert labels."""
    return projections.rate(enrich_inner(readings, stations))


def start_latest(
    rated: DataFrame, table: KeyedTable, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Keep one row per station, the newest seen."""
    writer = (
        with_slot(rated)
        .writeStream.outputMode("append")
        .foreachBatch(_upsert_into(table))
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def hourly_stream(
    rated: DataFrame,
    watermark: str | None = WATERMARK,
    width: str = "1 hour",
    keys: tuple[str, ...] = ("station_id", "province"),
    how: str = "fixed",
) -> DataFrame:
    """Windowed statistics; rows later than the watermark are dropped. A table needs no watermark."""
    timed = rated.withWatermark("timestamp", watermark) if watermark else rated
    return rollups.hourly_rollup(timed, width, keys, how)


def hourly_rows(windowed: DataFrame, tz_offset_hours: int = 7) -> DataFrame:
    """Windowed statistics as rows of the hourly series, with their stable id."""
    local = projections.with_day(projections.local_hours(windowed, tz_offset_hours))
    named = projections.serving_aliases(local)
    labelled = named.withColumns(
        {
            "aqi_alert": rules.aqi_alert("avg_aqi"),
            "temp_alert": rules.temp_alert("avg_temp"),
        }
    )
    return labelled.withColumn("_id", rules.hour_key("station_id", "timestamp"))


def start_hourly(
    hourly: DataFrame, table: KeyedTable, checkpoint: str, interval: str | None = None
) -> StreamingQuery:
    """Upsert each re-emitted hour; the running hour is refreshed with every batch."""
    writer = (
        hourly.writeStream.outputMode("update")
        .foreachBatch(_upsert_into(table))
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer, interval).start()


def run_until_any_stops(queries: Iterable[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Block until one query ends; stop the others and raise what it failed with.

    Only the queries given count, not others the session ran before.
    """
    started = list(queries)
    try:
        while not any(query.awaitTermination(poll_seconds) for query in started):
            pass
    finally:
        for query in started:
            if query.isActive:
                query.stop()


def log_counts(*queries: StreamingQuery) -> None:
    """What the latest batches held, in the log: the last look at queries that count."""
    for query in queries:
        for counts in batch_counts(query):
            _LOG.info("batch %(batch)s: %(rows)s rows, %(accepted)s accepted, %(rejected)s rejected", counts)


def drain(*queries: StreamingQuery) -> None:
    """Wait for queries that process what is available and end; if one fails, stop the others."""
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
