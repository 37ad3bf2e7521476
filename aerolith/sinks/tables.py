"""Files and views written by the batch side."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import schemas
from aerolith.session import delete_path, folders

VERSION = "v"


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by ``by``.

    The rebalance hint brings rows of one partition together so files stay large, and lets
    adaptive execution split a partition that outgrows the advisory size, so no single task
    writes a whole hot region or day.
    """
    df.hint("rebalance", *[F.col(c) for c in by]).write.mode(mode).partitionBy(*by).parquet(path)


def write_enriched_lake(enriched: DataFrame, path: str) -> None:
    write_partitioned(enriched, path, "region", "date")


def write_processed(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def _versions(spark: SparkSession, root: str, name: str, whole: bool = True) -> list[str]:
    """The folders of a view's versions, oldest first; a version is whole once its commit mark is there."""
    mark = "/_SUCCESS" if whole else ""
    found = folders(spark, f"{root}/{name}/{VERSION}*{mark}")
    return sorted(path.removesuffix(mark) for path in found)


def publish_view(df: DataFrame, root: str, name: str, keep: int = 2, table: str | None = None) -> str:
    """Replace a named view without a gap; returns the folder of the new version.

    Every version has a folder of its own, and readers take the newest whole one: they see the old rows or the new
    ones, never none or half. ``table`` names a catalog table that is pointed at the new version. The ``keep`` newest
    versions stay, for readers that began before; a broken write leaves a folder that nobody reads and the next publish clears.
    """
    spark = df.sparkSession
    every = _versions(spark, root, name, whole=False)
    number = int(every[-1].rsplit(VERSION, 1)[1]) + 1 if every else 0
    folder = f"{root}/{name}/{VERSION}{number:010d}"
    df.write.parquet(folder)
    if table:
        register_view(spark, root, name, table)
    whole = _versions(spark, root, name)
    for old in every:
        if old not in whole[-max(keep, 1) :]:
            delete_path(spark, old)
    return folder


def scan_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the four published views, as of its newest version."""
    if name not in schemas.VIEWS:
        raise ValueError(f"unknown view {name!r}")
    versions = _versions(spark, root, name)
    return spark.read.parquet(versions[-1] if versions else f"{root}/{name}")


def register_view(spark: SparkSession, root: str, name: str, table: str | None = None) -> None:
    """Make a published view readable by name in SQL, or point its name at the newest version."""
    versions = _versions(spark, root, name)
    location = versions[-1] if versions else f"{root}/{name}"
    target = table or name
    if spark.catalog.tableExists(target):
        spark.sql(f"ALTER TABLE {target} SET LOCATION '{location}'")
        spark.catalog.refreshTable(target)
    else:
        spark.sql(f"CREATE TABLE {target} USING parquet LOCATION '{location}'")


def drop_views(spark: SparkSession, root: str, *names: str, tables: tuple[str, ...] = ()) -> list[str]:
    """Drop views and registered names that exist; returns the views that did."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    return [name for name in names if delete_path(spark, f"{root}/{name}")]


def to_message_json(readings: DataFrame) -> DataFrame:
    """Readings as the JSON text of the feed, one ``value`` per row, unkeyed."""
    fields = [
        F.col(c).cast("string").alias(c) if c in ("date", "timestamp") else F.col(c)
        for c in schemas.READING.names
    ]
    return readings.select(F.to_json(F.struct(*fields)).alias("value"))


def send_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Batch write of ``to_message_json`` output to Kafka (connector package required)."""
    writer = messages.write.format("kafka").option("kafka.bootstrap.servers", servers)
    writer.option("topic", topic).save()


def export_station_csv(readings: DataFrame, path: str) -> None:
    """History CSV with header ``station_id,time,temp,rhum,pm25,no2``; null is an empty field."""
    readings.select(
        "station_id",
        F.col("timestamp").cast("string").alias("time"),
        F.col("temperature").alias("temp"),
        F.col("humidity").alias("rhum"),
        "pm25",
        "no2",
    ).write.mode("overwrite").csv(path, header=True, nullValue="", emptyValue="")
