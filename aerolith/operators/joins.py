"""Joins with the station dimension, merged feeds and the live-against-baseline join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolith.functions.rounding import half_up

def salted_join(
    left: DataFrame, right: DataFrame, on: str, how: str, salt_from: str, salts: int
) -> DataFrame:
    """Merge join that spreads each left key over ``salts`` tasks; the right side is repeated.

    The salt is a hash of ``salt_from``, so a recomputed task puts every row where it was.
    """
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(salt_from), F.lit(salts)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted_left.join(repeated.hint("merge"), [on, "_salt"], how).drop("_salt")


def heavy_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """``key, pieces``: the keys that hold more than ``share`` of the rows, and how many pieces of that size they make.

    A frequency sketch names them: one pass over the key column, combined before the shuffle. Fewer than
    ``1 / share`` keys can be that frequent, so the table is small whatever the input.
    """
    most = max(1, int(1 / share))
    sketch = f"approx_top_k({key}, {most}, {max(10_000, 4 * most)})"
    found = df.where(F.col(key).isNotNull()).agg(F.expr(sketch).alias("_top"), F.count(F.lit(1)).alias("_rows"))
    top = found.select("_rows", F.inline("_top")).where(F.col("count") > F.col("_rows") * share)
    return top.select(F.col("item").alias(key), F.ceil(F.col("count") / (F.col("_rows") * share)).cast("int").alias("pieces"))


def skew_join(
    left: DataFrame, right: DataFrame, on: str, how: str = "left", salt_from: str = "timestamp", parts_per_task: int = 16
) -> DataFrame:
    """Merge join in which only the heavy keys of ``left`` are spread, by their share of the rows.

    A key that holds more rows than a small part of a task's fair share is cut into such parts by a hash of
    ``salt_from``; its row on the right is repeated once per part, all other rows stay single. Null keys, which
    match nothing, are spread as well. A recomputed task puts every row where it was.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Fewer rows than tasks * parts_per_task: a proven bound for the broadcast.
    heavy = F.broadcast(heavy_keys(left, on, 1 / (tasks * parts_per_task)))
    spread = F.xxhash64(salt_from)
    nulls = F.when(F.col(on).isNull(), F.pmod(spread, F.lit(tasks * parts_per_task)))
    salt = F.coalesce(F.pmod(spread, F.col("pieces")), nulls, F.lit(0)).cast("int")
    salted = left.join(heavy, on, "left").withColumn("_salt", salt).drop("pieces")
    pieces = F.sequence(F.lit(0), F.coalesce("pieces", F.lit(1)) - 1)
    repeated = right.join(heavy, on, "left").withColumn("_salt", F.explode(pieces)).drop("pieces")
    return salted.join(repeated.hint("merge"), [on, "_salt"], how).drop("_salt")


def enrich_left(
    readings: DataFrame, stations: DataFrame, strategy: str = "auto", salts: int = 1
) -> DataFrame:
    """Every reading with its station's province and region, null for unknown stations.

    ``auto`` leaves the choice to Catalyst, which broadcasts below its size threshold and splits
    skewed merge partitions at run time. ``merge`` forces a sort-merge join; ``skew`` one that spreads the stations that
    hold much of the data, and only these (``skew_join``); ``salts`` above one spreads every station over that many tasks.
    """
    if strategy == "skew":
        return skew_join(readings, stations, "station_id", "left")
    if salts > 1:
        return salted_join(readings, stations, "station_id", "left", "timestamp", salts)
    if strategy == "merge":
        return readings.join(stations.hint("merge"), "station_id", "left")
    if strategy == "auto":
        return readings.join(stations, "station_id", "left")
    raise ValueError(f"unknown join strategy {strategy!r}")


def enrich_inner(readings: DataFrame, stations: DataFrame, salts: int = 1) -> DataFrame:
    """Readings of known stations only; works on a stream with a static dimension.

    Catalyst chooses the join by the dimension's size in bytes. ``salts`` above one forces a merge
    that spreads each station over that many tasks.
    """
    if salts > 1:
        return salted_join(readings, stations, "station_id", "inner", "timestamp", salts)
    return readings.join(stations, "station_id")


def merge_feeds(
    forecast: DataFrame,
    archive: DataFrame,
    air: DataFrame,
    key: str = "station_id",
    position: str | None = None,
) -> DataFrame:
    """Hourly rows keyed by station and time from three feeds; forecast wins over archive.

    A feed may repeat an hour if ``position`` names its column of array places: of weather the first
    value that is not null counts, of air the last row. Without it hours must be unique in a feed.

    The full outer merge is one aggregation of the feeds' union: a single shuffle with map-side
    combining, where two outer joins would each shuffle and sort everything.
    """
    weather = ("temperature", "humidity")
    columns = {
        "_forecast_temperature": "double",
        "_forecast_humidity": "double",
        "_archive_temperature": "double",
        "_archive_humidity": "double",
        "pm25": "double",
        "no2": "double",
    }
    place = F.col(position).cast("int") if position else F.lit(0)

    def widened(df: DataFrame, prefix: str, names: tuple[str, ...]) -> DataFrame:
        present = {prefix + n: F.col(n) for n in names}
        return df.select(
            key,
            "time",
            *[present.get(c, F.lit(None)).cast(t).alias(c) for c, t in columns.items()],
            place.alias("_place"),
            (place if "pm25" in names else F.lit(None).cast("int")).alias("_air_place"),
        )

    def chosen(name: str) -> Column:
        if name in ("pm25", "no2"):
            return F.expr(f"max_by({name}, _air_place) AS {name}")
        return F.expr(f"min_by({name}, _place) FILTER (WHERE {name} IS NOT NULL) AS {name}")

    feeds = [
        widened(forecast, "_forecast_", weather),
        widened(archive, "_archive_", weather),
        widened(air, "", ("pm25", "no2")),
    ]
    merged = reduce(DataFrame.unionByName, feeds).groupBy(key, "time").agg(
        *[chosen(c) for c in columns]
    )

    def preferred(name: str) -> str:
        return f"coalesce(_forecast_{name}, _archive_{name})"

    return merged.select(
        key,
        "time",
        half_up(preferred("temperature"), 1).alias("temperature"),
        half_up(preferred("humidity"), 0).alias("humidity"),
        half_up("pm25", 1).alias("pm25"),
        half_up("no2", 1).alias("no2"),
    )


def with_city(df: DataFrame, registry: DataFrame) -> DataFrame:
    """City id by province name; null when the province is not registered."""
    cities = registry.groupBy("province").agg(F.min("city_id").alias("city_id"))
    return df.join(cities, "province", "left")


def current_against_baseline(realtime: DataFrame, summary: DataFrame) -> DataFrame:
    """One row per station present on both sides."""
    baseline = summary.select(
        "station_id",
        F.col("avg_temp").alias("historical_avg_temp"),
        F.col("avg_pm25").alias("historical_avg_pm25"),
    )
    return realtime.join(baseline, "station_id")
