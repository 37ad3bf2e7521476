"""Jobs: landing, live views and the daily batch.

python -m aerolith land  --servers HOST:PORT --topic T --lake DIR --checkpoints DIR
python -m aerolith speed --servers HOST:PORT --topic T --stations CSV --views DIR --checkpoints DIR
python -m aerolith batch --stations CSV --views DIR [--history DIR] [--lake DIR] [--as-of YYYY-MM-DD] [--state DIR]

python -m aerolith fill  --stations CSV --forecast DIR --archive DIR --air DIR --what views,batch,today,history ...

``fill`` builds views, today's hours or the history file from hourly feeds (JSON lines of ``station_id`` and ``payload``).
``--feed DIR`` reads message files in place of Kafka; ``--once`` ends when all is read.
"""

from __future__ import annotations

import argparse
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aerolith import schemas
from aerolith.operators.rollups import SUMMARY_KEYS
from aerolith.plans import backfill
from aerolith.plans.daily_state import run_daily_increment
from aerolith.plans.views import run_daily_batch
from aerolith.session import build_session
from aerolith.sinks import keyed
from aerolith.sources import messages
from aerolith.sources.registry import scan_stations
from aerolith.streaming import speed


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.feed:
        return messages.file_messages(spark, args.feed)
    return messages.kafka_messages(spark, args.servers, args.topic, args.starting_offsets)


def _finish(args: argparse.Namespace, *queries) -> None:
    if args.once:
        speed.drain(*queries)
    else:
        speed.run_until_any_stops(queries)


def land(spark: SparkSession, args: argparse.Namespace) -> None:
    interval = None if args.once else args.interval
    raw = _messages(spark, args)
    valid = messages.valid_readings(messages.decode_readings(raw))
    landed = speed.land_stream(valid, args.lake, f"{args.checkpoints}/landing", interval)
    held = speed.quarantine_stream(
        messages.quarantined(raw), f"{args.lake}_rejected", f"{args.checkpoints}/rejected", interval
    )
    _finish(args, landed, held)


def run_speed(spark: SparkSession, args: argparse.Namespace) -> None:
    interval = None if args.once else args.interval
    stations = scan_stations(spark, args.stations).select(*schemas.STATION.names)
    readings = messages.decode_readings(_messages(spark, args))
    rated, counted = speed.rated_stream(readings, stations), speed.counted_stream(readings, stations)
    windows = speed.hourly_stream(rated, args.watermark, args.window, SUMMARY_KEYS)
    live = keyed.snapshot_table(f"{args.views}/realtime", schemas.REALTIME_VIEW)
    series = keyed.series_table(f"{args.views}/hourly", schemas.HOURLY_VIEW)
    with speed.state_settings(spark, args.state_partitions):
        queries = (
            speed.start_latest(counted, live, f"{args.checkpoints}/realtime", interval),
            speed.start_hourly(
                speed.hourly_rows(windows, args.tz_offset), series, f"{args.checkpoints}/hourly", interval
            ),
        )
        _finish(args, *queries)
    speed.log_counts(queries[0])


def batch(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.state:
        as_of = args.as_of or date.today()
        run_daily_increment(spark, args.stations, args.lake, args.state, args.views, as_of, args.days, args.again)
        return
    run_daily_batch(
        spark,
        args.stations,
        args.views,
        args.as_of or date.today(),
        args.history,
        args.lake,
        args.fallback,
        args.days,
        args.window_history,
    )


def _feed_files(spark: SparkSession, path: str, payload: T.StructType) -> DataFrame:
    schema = T.StructType([T.StructField("station_id", T.StringType()), T.StructField("payload", payload)])
    return spark.read.schema(schema).json(path)


def fill(spark: SparkSession, args: argparse.Namespace) -> None:
    """All four views (``views``), the two batch views, today's hours, or the history file, each if asked for."""
    wanted = set(args.what.split(","))
    if unknown := wanted - {"views", "batch", "today", "history"}:
        raise ValueError(f"unknown parts {sorted(unknown)}")
    stations = scan_stations(spark, args.stations).select(*schemas.STATION.names)
    feeds = [
        _feed_files(spark, path, kind)
        for path, kind in (
            (args.forecast, schemas.WEATHER_ARRAYS),
            (args.archive, schemas.WEATHER_ARRAYS),
            (args.air, schemas.AIR_ARRAYS),
        )
    ]
    rows = backfill.feed_rows(*feeds)
    if wanted & {"views", "batch", "history"}:
        history = backfill.keep(backfill.recent_history(rows, stations, args.anchor or date.today(), args.days))
        if "views" in wanted:
            backfill.seed_views(history, args.views)
        elif "batch" in wanted:
            backfill.publish_batch_views(history, args.views)
        if "history" in wanted:
            backfill.export_history(history, args.history)
    if "today" in wanted:
        now = datetime.fromisoformat(args.now) if args.now else datetime.now()
        series = keyed.series_table(f"{args.views}/{args.series}", schemas.HOURLY_VIEW)
        backfill.fill_today(rows, stations, now, series)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="aerolith")
    jobs = top.add_subparsers(required=True)
    feed = argparse.ArgumentParser(add_help=False)
    feed.add_argument("--servers")
    feed.add_argument("--topic")
    feed.add_argument("--starting-offsets", default="latest")
    feed.add_argument("--feed")
    feed.add_argument("--checkpoints", required=True)
    feed.add_argument("--interval", default=speed.TRIGGER)
    feed.add_argument("--once", action="store_true")
    job = jobs.add_parser("land", parents=[feed])
    job.add_argument("--lake", required=True)
    job.set_defaults(run=land)
    job = jobs.add_parser("speed", parents=[feed])
    job.add_argument("--stations", required=True)
    job.add_argument("--views", required=True)
    job.add_argument("--watermark", default=speed.WATERMARK)
    job.add_argument("--window", default="1 hour")
    job.add_argument("--tz-offset", type=int, default=7)
    job.add_argument("--state-partitions", type=int, default=200)
    job.set_defaults(run=run_speed)
    job = jobs.add_parser("batch")
    job.add_argument("--stations", required=True)
    job.add_argument("--views", required=True)
    job.add_argument("--as-of")
    job.add_argument("--history")
    job.add_argument("--lake")
    job.add_argument("--fallback")
    job.add_argument("--days", type=int, default=30)
    job.add_argument("--window-history", action="store_true")
    job.add_argument("--state", help="folder of daily states: only days of the lake without one are read")
    job.add_argument("--again", nargs="*", default=(), help="days to read anew")
    job.set_defaults(run=batch)
    job = jobs.add_parser("fill")
    for name in ("stations", "forecast", "archive", "air", "what"):
        job.add_argument(f"--{name}", required=True)
    job.add_argument("--views")
    job.add_argument("--history")
    job.add_argument("--series", default="hourly", help="the hourly series under --views that today's hours go to")
    job.add_argument("--anchor", help="last day of the re-dated history, today if left out")
    job.add_argument("--now", help="the time that counts as now")
    job.add_argument("--days", type=int, default=backfill.DAYS)
    job.set_defaults(run=fill)
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(spark or build_session(), args)


if __name__ == "__main__":
    main()
