"""Sorting, top-k and global ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.functions import rules
from aerolith.session import run_dir

_MOST = 1.7e308


def top_n(df: DataFrame, metric: str, n: int = 5, key: str = "station_id") -> DataFrame:
    """The ``n`` rows with the greatest metric; each task forwards at most ``n`` rows."""
    return df.orderBy(F.desc_nulls_last(metric), key).limit(n)


def by_exceedance(alerts: DataFrame) -> DataFrame:
    """Alerts with ``ratio``, their value over their display threshold, the farthest beyond it first."""
    _, threshold = rules.alert_display("alert_type", "level")
    return alerts.withColumn("ratio", F.col("value") / threshold).orderBy(*exceedance_order())


def exceedance_order() -> tuple[Column, ...]:
    return F.desc("ratio"), F.asc("station_id"), F.asc("alert_type")


def top_lists(df: DataFrame, metrics: dict[str, str], n: int = 5, key: str = "station_id") -> DataFrame:
    """Several lists of the ``n`` rows with the greatest metric, in one pass: ``list, place`` and the row.

    Rows are repeated once per metric inside a task, which forwards at most ``n`` of them for each list.
    """
    value = F.array(*[F.struct(F.lit(name).alias("list"), F.col(m).cast("double").alias("_by")) for name, m in metrics.items()])
    repeated = df.select("*", F.inline(value))
    best = Window.partitionBy("list").orderBy(F.desc_nulls_last("_by"), key)
    return repeated.withColumn("place", F.row_number().over(best)).where(F.col("place") <= n).drop("_by")


def sort_key(field: str, direction: str = "asc") -> Column:
    """Missing values sort below every value, whichever the direction."""
    return F.desc_nulls_last(field) if direction == "desc" else F.asc_nulls_first(field)


def sort_rows(df: DataFrame, field: str, direction: str = "asc", key: str = "station_id") -> DataFrame:
    return df.orderBy(sort_key(field, direction), key)


def rank_bounded(listed: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """1..n over a list already limited to a few rows (a top-k report)."""
    return listed.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def share_of_max(listed: DataFrame, metric: str, name: str = "share") -> DataFrame:
    """Value over the greatest value of the few rows listed."""
    return listed.withColumn(name, F.try_divide(F.col(metric), F.max(metric).over(Window.partitionBy())))


def _place(df: DataFrame, column: str) -> Column:
    """A number that never falls where the column rises: equal for nulls, and perhaps for values that are close."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(F.encode(c, "UTF-8"), 1, 6)), 12, "0")
        return F.conv(head, 16, 10).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")


def rank_by(
    df: DataFrame, field: str, direction: str = "asc", keys: Sequence[str] = ("station_id",), name: str = "rank", ranges: int | None = None
) -> DataFrame:
    """1..n by ``sort_key(field, direction)``, then ``keys``, over a table of any size, as one lazy query.

    A quantile sketch of the field and of the first key gives splitters; rows are numbered within the range
    between two splitters and moved up by the counts of the ranges before. A value that fills ranges of its own (a third of
    all rows, say) is split by its key, so no range is much larger than the others. Nothing is written.
    """
    tasks = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = F.array(*[F.lit(n / tasks) for n in range(1, tasks)] or [F.lit(0.5)])
    value = _place(df, field)
    value = F.when(F.isnan(value), F.lit(_MOST)).otherwise(F.greatest(F.least(value, F.lit(_MOST)), F.lit(-_MOST)))
    # Missing values stand below all others: first if ascending, last if descending.
    value = F.when(F.col(field).isNull(), F.lit(-_MOST)).otherwise(value) * F.lit(-1.0 if direction == "desc" else 1.0)
    placed = df.withColumns({"_value": value, "_key": F.coalesce(_place(df, keys[0]), F.lit(-_MOST))})
    sketch = F.struct(*[F.percentile_approx(c, shares, 10_000).alias(c) for c in ("_value", "_key")])
    placed = placed.withColumn("_splitters", placed.agg(sketch.alias("_splitters")).scalar())

    def below(column: str, equal: bool = False) -> Column:
        def test(s: Column) -> Column:
            return s <= F.col(column) if equal else s < F.col(column)

        return F.coalesce(F.size(F.filter(F.col("_splitters")[column], test)), F.lit(0))

    counted = placed.withColumn("_low", below("_value"))
    # A value that is two splitters or more is a range of its own, cut by the key.
    own = below("_value", True) - F.col("_low") >= 2
    dealt = counted.withColumns({"_range": F.col("_low") * 2 + own.cast("int"), "_cut": F.when(own, below("_key")).otherwise(F.lit(0))})
    before = Window.orderBy("_range", "_cut").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range and cut: a number that depends on ``ranges`` only.
    offsets = (
        dealt.groupBy("_range", "_cut")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_range", "_cut", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range", "_cut").orderBy(sort_key(field, direction), *keys)
    numbered = dealt.withColumn("_nth", F.row_number().over(inside)).join(F.broadcast(offsets), ["_range", "_cut"])
    return numbered.select(*df.columns, (F.col("_nth") + F.col("_offset")).alias(name))


def global_rank(df: DataFrame, *order: Column | str, name: str = "rank") -> DataFrame:
    """1..n in any total order over a table of any size, without bringing it to one task; ``rank_by`` needs no table.

    Rows are range-partitioned by the order (which must be total) and written to the shared
    folder, so both passes below see the same partitions even when an executor is lost between
    them. Each partition is then numbered on its own and moved up by the rows of those before.
    """
    spark = df.sparkSession
    path = run_dir(spark, "ranked")
    df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    placed = spark.read.parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # One offset per shuffle partition: bounded by spark.sql.shuffle.partitions.
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(name, within + F.col("_offset"))
        .drop("_part", "_offset")
    )
