"""Newest rows per key."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_SERIES = 30
MAX_SERIES = 500


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest: Sequence[str], tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The whole row with the greatest ``newest`` (then ``tiebreak``) of each key.

    An aggregate rather than a window: every task sends on at most one row per key, so a key
    that holds much of the data costs no more than any other. The remaining columns break the
    ties that are left, which keeps the result the same on every run.
    """
    rest = [c for c in df.columns if c not in keys]
    leading = [*newest, *tiebreak]
    whole = F.struct(*leading, *[c for c in rest if c not in leading])
    return (
        df.groupBy(*keys)
        .agg(F.max(whole).alias("_row"))
        .select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
    )


def latest_rows(
    df: DataFrame, keys: Sequence[str], newest: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """``latest_per_key`` of a table, reading whole rows late; the same rows, ties included.

    The greatest ``newest`` of each key is a hash aggregate over two narrow columns. Only rows at least as new as the
    oldest of these maxima can be among the latest: that bound is a subquery that reaches the scan of the
    full rows, and what passes it meets the maxima in a join. Rows tied in time are told apart by a window over the few left.
    """
    greatest = df.groupBy(*keys).agg(F.max(newest).alias("_newest"))
    bound = greatest.agg(F.min("_newest")).scalar()
    recent = df.where((F.col(newest) >= bound) | F.col(newest).isNull())
    at = greatest.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "_newest")
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    tied = recent.join(at, [*same, F.col(newest).eqNullSafe(F.col("_newest"))], "left_semi")
    rest = [c for c in df.columns if c not in {*keys, newest, *tiebreak}]
    first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in (*tiebreak, *rest)] or [F.lit(0)])
    return tied.withColumn("_n", F.row_number().over(first)).where(F.col("_n") == 1).drop("_n").select(*df.columns)


def clamp_limit(limit: int | str | None) -> int:
    """Series length: 30 when absent, zero or not starting with a number, else held within 1..500."""
    leading = re.match(r"\s*([+-]?\d+)", str(limit or ""))
    wanted = int(leading.group(1)) if leading else 0
    return min(max(wanted or DEFAULT_SERIES, 1), MAX_SERIES)


def last_n(
    df: DataFrame, n: int, key: str = "station_id", order: str = "timestamp", tiebreak: Sequence[str] = ()
) -> DataFrame:
    """The newest ``n`` rows of each key; each task forwards at most ``n`` rows per key."""
    newest_first = Window.partitionBy(key).orderBy(F.desc(order), *[F.desc(c) for c in tiebreak])
    return (
        df.withColumn("_n", F.row_number().over(newest_first)).where(F.col("_n") <= n).drop("_n")
    )


def latest_day_of_view(df: DataFrame, key: str = "station_id") -> DataFrame:
    """``latest_day`` of a table filed by day: only days that are some key's last one are opened.

    The last days of all keys are a handful of dates, whatever the number of keys; their broadcast prunes the scan at
    run time. Rows without a day are in no day.
    """
    last = df.groupBy(key).agg(F.max("date").alias("_last"))
    # The comparison marks the side as selective, which run-time pruning asks for.
    days = last.where(F.col("_last") > "").select(F.col("_last").alias("date")).distinct()
    recent = df.join(F.broadcast(days), "date", "left_semi")
    own = last.select(F.col(key).alias("_key"), "_last")
    return recent.join(own, (F.col(key) == F.col("_key")) & (F.col("date") == F.col("_last")), "left_semi")


def latest_day(df: DataFrame, key: str = "station_id") -> DataFrame:
    """All rows of each key's latest day."""
    by_day = Window.partitionBy(key).orderBy(F.desc("date"))
    return df.withColumn("_r", F.rank().over(by_day)).where(F.col("_r") == 1).drop("_r")
