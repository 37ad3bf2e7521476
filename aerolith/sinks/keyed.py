"""Keyed upserts into partitioned Parquet."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.operators.latest import latest_per_key
from aerolith.session import delete_path, folders, path_exists, replace_path

WRITER = "upsert_writer"
_BATCH, _TURNS = "_batch", "_turns"


@dataclass(frozen=True)
class KeyedTable:
    """One row per key, replaced column by column by upserts.

    Each writer has a folder of its own, partitioned by ``partition``, with one row for every key it ever gave. An
    upsert joins its batch with the writer's rows of the touched partitions and replaces just these
    partitions. Writers never touch each other's files, a batch may hold some of the
    columns (the others keep their values), and rows stay as many as keys, however many batches come.

    Order survives replay. A row keeps the number of the last batch of its writer that changed it; a batch with that
    number or a smaller one leaves it as it is, so any old batch can be given again. Every column keeps its
    turn, one more than any turn found in the touched partitions of all writers when the batch came; ``read`` takes the
    greatest turn where writers differ (at equal turns, the greater writer name). With ``newest`` columns a
    row is replaced as a whole, and only by one that is not older.

    The merged partitions are written to a side folder first, then moved into place one by one. If the driver is lost
    meanwhile, the writer's next upsert moves the others before anything else; a reader may miss a partition at
    the moment of its move.
    ``spread`` tasks at most write one partition: a stream's batch often touches a single day.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    partition: str
    newest: tuple[str, ...] = ()
    spread: int = 8

    @property
    def _others(self) -> list[str]:
        return [name for name in self.schema.names if name not in self.keys]

    @property
    def _stored(self) -> T.StructType:
        marks = [T.StructField(_BATCH, T.LongType()), T.StructField(_TURNS, T.ArrayType(T.LongType()))]
        return T.StructType([*self.schema.fields, *marks])

    def _folder(self, writer: str) -> str:
        return f"{self.path}/{WRITER}={writer}"

    def _pending(self, writer: str) -> str:
        return f"{self.path}/_pending/{WRITER}={writer}"

    def read(self, spark: SparkSession) -> DataFrame:
        """The rows, one per key. A filter on the partition column or the keys reaches the scan if they are keys."""
        writers = folders(spark, f"{self.path}/{WRITER}=*")
        if not writers:
            return spark.createDataFrame([], self.schema)
        if len(writers) == 1:
            return spark.read.schema(self._stored).parquet(writers[0]).select(*self.schema.names)
        with_writer = T.StructType([*self._stored.fields, T.StructField(WRITER, T.StringType())])
        rows = spark.read.schema(with_writer).parquet(self.path)
        if self.newest:
            order = [F.col(c).alias(f"_by_{c}") for c in (*self.newest, _TURNS, WRITER)]
            whole = F.max(F.struct(*order, *self._others)).alias("_row")
            return rows.groupBy(*self.keys).agg(whole).select(*self.keys, "_row.*").select(*self.schema.names)

        def last_given(place: int, name: str) -> Column:
            turn = F.col(_TURNS)[place]
            return F.max_by(F.struct(name), F.when(turn.isNotNull(), F.struct(turn, WRITER)))[name].alias(name)

        columns = [last_given(n, name) for n, name in enumerate(self._others)]
        return rows.groupBy(*self.keys).agg(*columns).select(*self.schema.names)

    def upsert(self, batch: DataFrame, batch_id: int | None = None, writer: str = "manual") -> None:
        """Merge ``batch``; the same ``writer`` and ``batch_id``, or a smaller one, again changes nothing.

        Without a ``batch_id`` the batch comes after all that the writer gave before.
        """
        spark = batch.sparkSession
        needed = {*self.keys, self.partition, *(self.schema.names if self.newest else ())}
        if missing := needed - set(batch.columns):
            raise ValueError(f"a batch needs {sorted(missing)}")
        self.recover(spark, writer)
        given = [name for name in self.schema.names if name in batch.columns]
        rows = batch.select(*given).persist()
        try:
            # The partitions of one batch, days or a fixed number of slots, and whether a key comes twice in it.
            sizes = rows.groupBy(*dict.fromkeys((*self.keys, self.partition))).agg(F.count(F.lit(1)).alias("_n"))
            touched = dict(sizes.groupBy(self.partition).agg(F.max("_n")).collect())
            if touched:
                one = latest_per_key(rows, self.keys, self.newest) if max(touched.values()) > 1 or self._loose else rows
                self._merge(spark, one, list(touched), batch_id, writer)
        finally:
            rows.unpersist()

    @property
    def _loose(self) -> bool:
        """Rows of one key may lie in several partitions."""
        return self.partition not in self.keys and self.partition != SNAPSHOT_SLOT

    def _merge(self, spark: SparkSession, rows: DataFrame, touched: list, batch_id: int | None, writer: str) -> None:
        known = [v for v in touched if v is not None]
        inside = F.col(self.partition).isin(known)
        if len(known) < len(touched):
            inside = inside | F.col(self.partition).isNull()
        present = {unquote(path.rsplit("=", 1)[1]) for path in folders(spark, f"{self._folder(writer)}/{self.partition}=*")}
        exists = any(("__HIVE_DEFAULT_PARTITION__" if v is None else str(v)) in present for v in touched)
        writers = {path.rsplit("=", 1)[1] for path in folders(spark, f"{self.path}/{WRITER}=*")}
        if writers <= {writer} and batch_id is not None:
            turn, number = batch_id + 1, batch_id  # alone, the writer's numbers are turns
        else:
            with_writer = T.StructType([*self._stored.fields, T.StructField(WRITER, T.StringType())])
            turn, last = None, None
            if writers:
                seen = spark.read.schema(with_writer).parquet(self.path).where(inside)
                mine = F.when(F.col(WRITER) == writer, F.col(_BATCH))
                turn, last = seen.agg(F.max(F.array_max(_TURNS)), F.max(mine)).first()
            number = (-1 if last is None else last) + 1 if batch_id is None else batch_id
            turn = max(turn or 0, number) + 1
        merged = self._merged(spark, rows, inside, turn, number, writer) if exists else self._first(rows, turn, number)
        share = F.pmod(F.xxhash64(*self.keys), F.lit(self.spread))
        out = merged.repartition(self.partition, share).write.mode("overwrite").partitionBy(self.partition)
        if exists:
            out.option("partitionOverwriteMode", "static").parquet(self._pending(writer))
            self.recover(spark, writer)
        else:  # partitions that are new go to their place at once; a batch that broke there is given again
            out.option("partitionOverwriteMode", "dynamic").parquet(self._folder(writer))

    def _first(self, rows: DataFrame, turn: int, number: int) -> DataFrame:
        turns = F.array(*[F.lit(turn if name in rows.columns else None).cast("long") for name in self._others])
        columns = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in self.schema]
        return rows.select(*columns, F.lit(number).cast("long").alias(_BATCH), turns.alias(_TURNS))

    def _merged(self, spark: SparkSession, rows: DataFrame, inside: Column, turn: int, number: int, writer: str) -> DataFrame:
        """The writer's rows of the touched partitions with the batch's rows applied."""
        old = spark.read.schema(self._stored).parquet(self._folder(writer)).where(inside)
        new = rows.select(F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in rows.columns])
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.keys])
        applies = F.col("_new") & (F.col(_BATCH).isNull() | (F.col(_BATCH) < number))
        if self.newest:
            before, after = F.struct(*self.newest), F.struct(*[F.col(f"_new_{c}").alias(c) for c in self.newest])
            applies = applies & (F.col(_BATCH).isNull() | (after >= before))
        applies = F.coalesce(applies, F.lit(False))
        columns = {k: F.when(F.col(_BATCH).isNull(), F.col(f"_new_{k}")).otherwise(F.col(k)) for k in self.keys}
        turns = []
        for place, name in enumerate(self._others):
            if name in rows.columns:
                columns[name] = F.when(applies, F.col(f"_new_{name}")).otherwise(F.col(name))
                turns.append(F.when(applies, F.lit(turn).cast("long")).otherwise(F.col(_TURNS)[place]))
            else:
                columns[name] = F.col(name)
                turns.append(F.col(_TURNS)[place])
        marks = [F.when(applies, F.lit(number).cast("long")).otherwise(F.col(_BATCH)).alias(_BATCH), F.array(*turns).alias(_TURNS)]
        return old.join(new, same, "full_outer").select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in self.schema], *marks)

    def recover(self, spark: SparkSession, writer: str) -> None:
        """Move merged partitions into place if they were written whole, and clear the side folder."""
        pending = self._pending(writer)
        if path_exists(spark, f"{pending}/_SUCCESS"):
            for path in folders(spark, f"{pending}/{self.partition}=*"):
                replace_path(spark, path, f"{self._folder(writer)}/{path.rsplit('/', 1)[1]}")
        delete_path(spark, pending)

    def copy_to(self, other: KeyedTable, spark: SparkSession) -> None:
        """All rows as one batch of ``other``, a new table with one writer."""
        other.upsert(self.read(spark), writer="copy")


SNAPSHOT_SLOT = "slot"
# Spreads the rows of a batch; a row's slot has no part in finding the newest.
SNAPSHOT_SLOTS = 16


def snapshot_table(path: str, schema: T.StructType, key: str = "station_id") -> KeyedTable:
    """Latest row per key; the newest timestamp wins. Rows are filed by a hash slot of the key."""
    filed = T.StructType([*schema.fields, T.StructField(SNAPSHOT_SLOT, T.IntegerType())])
    return KeyedTable(path, filed, (key,), SNAPSHOT_SLOT, ("timestamp",), spread=1)


def with_slot(df: DataFrame, key: str = "station_id") -> DataFrame:
    return df.withColumn(SNAPSHOT_SLOT, F.pmod(F.xxhash64(key), F.lit(SNAPSHOT_SLOTS)).cast("int"))


def series_table(path: str, schema: T.StructType, key: str = "_id") -> KeyedTable:
    """Rows with a stable id, filed by day; the row written last wins."""
    fields = schema.fields if key in schema.names else [T.StructField(key, T.StringType()), *schema.fields]
    return KeyedTable(path, T.StructType(fields), ("date", key), "date")
