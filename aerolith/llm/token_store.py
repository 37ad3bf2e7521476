"""Token ids in binary shards with a minimal perfect hash index over the document keys.

File format: a table in the shared folder, a row per shard of about ``SHARD_IDS`` ids. ``payload`` is the raw
ids of the shard's documents one after the other, little-endian, ``width`` bytes each (2 where the
vocabulary allows, else 4). Shards are numbered in ascending order of ``doc_id`` (null ids last); the table is
partitioned by the part (task) that wrote them and bucketed by shard, so reads of many keys move keys and never payloads.

Index: keys (``doc_id``, n-th row with that id) are dealt into buckets of about ``KEYS_PER_BUCKET``. Each bucket is
one row with a minimal perfect hash (hash and displace): a key's sub-bucket gives a displacement, which
gives its slot; the slot holds a 16-bit fingerprint of the key, the shard, the offset, the length and the place in the whole
store. A look-up is a few array reads whatever the size; a key that was never stored is refused by its
fingerprint but for one chance in 65,536.

Up to ``FEW`` keys are looked up by number: their buckets, then their shards, are literals that prune partitions, files
and row groups, so one key opens one bucket and one shard. More keys meet index and shards in joins.

A null or empty text is the end id alone. An empty table gives empty files. Rows that repeat are all kept.
"""

from __future__ import annotations

import itertools
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm.arrays import mix, ragged
from aerolith.llm.bpe import vocabulary_path
from aerolith.llm.packing import token_batches
from aerolith.llm.tables import id_key, id_value, stored, texts
from aerolith.session import run_dir

END_ID = 2
SHARD_IDS = 1 << 19
KEYS_PER_BUCKET = 1 << 13
KEYS_PER_SLOT_GROUP = 4
FEW = 1000
SHARD = "part int, shard long, width int, n_ids long, doc_ids binary, nths binary, counts binary, payload binary"
INDEX = "bucket long, n_keys int, displacements binary, prints binary, shards binary, offsets binary, lengths binary, starts binary"
ENTRY = "doc_id long, nth long, shard long, offset long, length long, start long"


def write_shards(docs: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Encode and write all documents in ascending order; returns the shard table."""
    spark = docs.sparkSession
    path = vocabulary or vocabulary_path()
    ordered = (
        texts(docs)
        .select(id_key().alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = itertools.count(TaskContext.get().partitionId() << 32)
        held, size, last, nth = [], 0, None, 0
        for doc_ids, flat, offsets in token_batches(batches, path, end_id):
            keys = doc_ids.to_numpy()
            nths = np.zeros(len(keys), np.int64)
            for i in range(len(keys)):
                nth = nth + 1 if keys[i] == last else 0
                last, nths[i] = keys[i], nth
            for a, b in _runs(np.diff(offsets), SHARD_IDS):
                held.append((keys[a:b], nths[a:b], np.diff(offsets[a : b + 1]), flat[offsets[a] : offsets[b]]))
                size += offsets[b] - offsets[a]
                if size >= SHARD_IDS:
                    yield _shard(next(number), held)
                    held, size = [], 0
        if held:
            yield _shard(next(number), held)

    name = f"token_shards_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        ordered.mapInArrow(shards, SHARD)
        .write.option("path", run_dir(spark, "shards"))
        .option("compression", "zstd")
        .option("parquet.block.size", str(32 << 20))
        .partitionBy("part")
        .bucketBy(buckets, "shard")
        .saveAsTable(name)
    )
    return spark.table(name)


def _runs(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    part = np.cumsum(sizes) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(sizes)]
    return list(zip(cuts[:-1], cuts[1:], strict=True)) if len(sizes) else []


def _shard(number: int, held: list) -> pa.RecordBatch:
    keys, nths, counts, ids = (np.concatenate([h[k] for h in held]) for k in range(4))
    width = 2 if not len(ids) or ids.max() < 1 << 16 else 4
    row = [
        pa.array([number >> 32], pa.int32()), pa.array([number], pa.int64()), pa.array([width], pa.int32()), pa.array([len(ids)], pa.int64()),
        *(pa.array([x.astype("<i8").tobytes()], pa.binary()) for x in (keys, nths, counts)),
        pa.array([ids.astype(f"<u{width}").tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(row, ["part", "shard", "width", "n_ids", "doc_ids", "nths", "counts", "payload"])


# Keys


def _key_hash(doc_ids: np.ndarray, nths: np.ndarray, seed: int) -> np.ndarray:
    return mix(mix(doc_ids.astype(np.int64).view(np.uint64)) ^ (nths.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)))


def _slots(hashes: np.ndarray, displacements: np.ndarray, size: int) -> np.ndarray:
    """Slot of each key: a negative displacement names the slot, others shift the key's own place."""
    shift = displacements[_groups(hashes, len(displacements))]
    moved = mix(hashes ^ (shift.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))) % np.uint64(max(size, 1))
    return np.where(shift < 0, -shift - 1, moved.astype(np.int64))


def _groups(hashes: np.ndarray, count: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) % np.uint64(max(count, 1))).astype(np.int64)


def perfect_hash(hashes: np.ndarray) -> np.ndarray:
    """Displacements that give distinct 64-bit hashes the slots 0 to n-1 without a collision."""
    n = len(hashes)
    groups = _groups(hashes, count := max(1, -(-n // KEYS_PER_SLOT_GROUP)))
    order = np.argsort(groups, kind="stable")
    sizes = np.bincount(groups, minlength=count)
    begins = np.cumsum(sizes) - sizes
    shifts, taken = np.zeros(count, np.int64), np.zeros(n, bool)
    for group in np.argsort(-sizes, kind="stable").tolist():
        if sizes[group] < 2:
            break
        members = hashes[order[begins[group] : begins[group] + sizes[group]]]
        for first in itertools.count(0, 64):
            tries = np.arange(first, first + 64, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
            slots = np.sort((mix(members[None, :] ^ tries[:, None]) % np.uint64(n)).astype(np.int64), axis=1)
            good = ~taken[slots].any(axis=1) & (np.diff(slots, axis=1) > 0).all(axis=1)
            if good.any():
                at = int(good.argmax())
                shifts[group] = first + at
                taken[slots[at]] = True
                break
    single = np.flatnonzero(sizes == 1)
    shifts[single] = -np.flatnonzero(~taken)[: len(single)] - 1
    return shifts


def prints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(48)).astype(np.uint16)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``shard, first``: the ids of all shards before it, by sums within each part and sums of whole parts."""
    sizes = shards.select("part", "shard", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per part, as many as the tasks that wrote the shards: small enough for one window and a broadcast.
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("_n")).select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    within = sizes.withColumn("_within", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return within.join(F.broadcast(parts), "part").select("shard", (F.col("_before") + F.col("_within")).alias("first"))


def build_index(shards: DataFrame) -> DataFrame:
    """The index table: a row per bucket of keys."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, nths, counts = (np.frombuffer(row[c], "<i8") for c in ("doc_ids", "nths", "counts"))
                offsets = np.cumsum(counts) - counts
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (keys, nths, np.full(len(keys), row["shard"]), offsets, counts, row["first"] + offsets)],
                    ["doc_id", "nth", "shard", "offset", "length", "start"],
                )

    known = shards.select("shard", "doc_ids", "nths", "counts").join(shard_starts(shards), "shard")
    rows = stored(known.mapInArrow(entries, ENTRY), "entries")
    buckets = max(1, -(-rows.count() // KEYS_PER_BUCKET))

    def build(key: tuple, table: pa.Table) -> pa.Table:
        doc_ids, nths, *values = (np.asarray(table.column(c)) for c in ("doc_id", "nth", "shard", "offset", "length", "start"))
        hashes = _key_hash(doc_ids, nths, 1)
        shifts = perfect_hash(hashes)
        slot = np.argsort(_slots(hashes, shifts, len(hashes)))
        blobs = [
            shifts.astype("<i4"), prints(hashes)[slot].astype("<u2"), *(v[slot].astype("<i8") for v in values),
        ]
        columns = [pa.array([key[0].as_py()], pa.int64()), pa.array([len(hashes)], pa.int32())]
        names = ["bucket", "n_keys", "displacements", "prints", "shards", "offsets", "lengths", "starts"]
        return pa.table([*columns, *(pa.array([b.tobytes()], pa.binary()) for b in blobs)], names)

    built = _bucketed(rows, buckets).groupBy("bucket").applyInArrow(build, INDEX)
    # Sorted, in small row groups: a bucket asked for by number is found by the statistics of the files.
    index = stored(built.sortWithinPartitions("bucket"), "index", **{"parquet.block.size": str(1 << 20)})
    return index.withMetadata("bucket", {"buckets": buckets})


def _bucketed(keys: DataFrame, buckets: int) -> DataFrame:
    return keys.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "nth"), F.lit(buckets)))


def locate(index: DataFrame, keys: DataFrame) -> DataFrame:
    """Shard, offset, length and start of each key (``doc_id, nth``) that the index knows."""
    buckets = index.schema["bucket"].metadata["buckets"]
    asked = (
        _bucketed(keys.select("doc_id", "nth"), buckets)
        .withColumn("_part", F.pmod(F.xxhash64("nth", "doc_id"), F.lit(4)))
        .groupBy("bucket", "_part")
        .agg(F.collect_list("doc_id").alias("doc_id"), F.collect_list("nth").alias("nth"))
    )

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, nths = np.array(row["doc_id"], np.int64), np.array(row["nth"], np.int64)
                hashes = _key_hash(doc_ids, nths, 1)
                slot = _slots(hashes, np.frombuffer(row["displacements"], "<i4").astype(np.int64), row["n_keys"])
                known = np.frombuffer(row["prints"], "<u2")[slot] == prints(hashes)
                slot = slot[known]
                found = [np.frombuffer(row[c], "<i8")[slot] for c in ("shards", "offsets", "lengths", "starts")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (doc_ids[known], nths[known], *found)], ["doc_id", "nth", "shard", "offset", "length", "start"]
                )

    return asked.hint("merge").join(index, "bucket").drop("bucket", "_part").mapInArrow(look_up, ENTRY)


def read_keys(shards: DataFrame, index: DataFrame, keys: DataFrame, with_ids: bool = True, many: bool = False) -> DataFrame:
    """``doc_id, nth, start, n_tokens, ids_crc32`` and, if asked for, ``ids`` of each stored key. ``many`` spares the
    look whether the keys are few."""
    spark = shards.sparkSession
    buckets = index.schema["bucket"].metadata["buckets"]
    few = None if many else _bucketed(keys.select("doc_id", "nth"), buckets).limit(FEW + 1).collect()
    if few is not None and len(few) <= FEW:
        asked = spark.createDataFrame([(r.doc_id, r.nth) for r in few], "doc_id long, nth long")
        found = locate(index.where(F.col("bucket").isin(sorted({r.bucket for r in few}))), asked).collect()
        opened = sorted({r.shard for r in found})
        shards = shards.where(F.col("part").isin(sorted({s >> 32 for s in opened})) & F.col("shard").isin(opened))
        located = spark.createDataFrame([tuple(r) for r in found], ENTRY)
    else:
        located = locate(index, keys)
    wanted = located.groupBy("shard").agg(F.collect_list(F.struct("doc_id", "nth", "offset", "length", "start")).alias("wanted"))
    schema = "doc_id long, nth long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = np.frombuffer(row["payload"], f"<u{row['width']}").astype("<u4")
                doc_ids, nths, offsets, lengths, starts = (
                    np.array([w[k] for w in row["wanted"]], np.int64) for k in ("doc_id", "nth", "offset", "length", "start")
                )
                crc = [zlib.crc32(ids[o : o + n]) for o, n in zip(offsets.tolist(), lengths.tolist(), strict=True)]
                columns = [doc_ids, nths, starts, lengths, np.array(crc, np.int64)]
                names = ["doc_id", "nth", "start", "n_tokens", "ids_crc32"]
                arrays = [pa.array(c) for c in columns]
                if with_ids:
                    flat = ids[ragged(offsets, lengths)].astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    # A merge: index and payloads are sorted or bucketed, and neither is ever sent whole to every task.
    joined = wanted.hint("merge").join(shards.select("shard", "width", "payload"), "shard").select("wanted", "width", "payload")
    return joined.mapInArrow(read, schema)


def store_digest(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write, index and read back every document: ``doc_id, start, n_tokens, ids_crc32``."""
    shards = write_shards(docs, vocabulary)
    index = build_index(shards)
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("doc_id")) - 1
    keys = docs.select(id_key().alias("doc_id")).withColumn("nth", nth.cast("long"))
    return read_keys(shards, index, keys, with_ids=False, many=True).select(id_value("doc_id").alias("doc_id"), "start", "n_tokens", "ids_crc32")
