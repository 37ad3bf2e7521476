"""Repeated substrings by sharded suffix arrays.

Every byte that lies in a string of ``length`` bytes (a window) which also starts anywhere else, in the same
document or another, is removed. Texts are UTF-8 bytes, windows never cross documents, and all windows are
judged on the input. A null or empty text has no bytes; an empty table gives an empty result.

1. Equal texts are one class (SHA-256); of a class with two or more documents every window repeats.
2. Each window has an anchor: the place of its smallest 16-byte hash. Equal windows have equal anchors and so
   the same ``KEY`` bytes after them. Windows whose key occurs once cannot repeat and leave here.
3. The text around an anchor, with the windows it owns, is a segment. Equal segments are combined
   before the shuffle, so a passage that a third of all documents hold arrives once per task. Segments are
   dealt into shards of about ``SHARD`` bytes by key; a key with more than ``MOST`` different segments is split
   over several shards.
4. Each shard builds a suffix array by Larsson-Sadakane refinement (groups of equal prefixes are doubled in
   depth, only unresolved ones are sorted) and common prefixes of neighbours by Kasai's recurrence. Runs of
   neighbours that share ``length`` bytes are equal windows.
5. For split keys the windows that a shard found once are merged across shards: sorted fingerprints
   (128 bits) are met by binary search in the runs of all shards.
"""

from __future__ import annotations

import hashlib
import itertools
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.arrays import list_array, mix, ragged, sliced, text_bytes
from aerolith.llm.tables import id_key, id_value, stored, texts
from aerolith.session import run_dir

LENGTH = 200
KEY = 64
SHARD = 1 << 19
MOST = 2048
_ODD = np.uint64(0x9E3779B97F4A7C15)
SCAN = "row long, doc_id long, n_bytes long, sha binary, firsts array<int>, keys array<long>, own array<long>"
SUSPECT = "row long, text binary, firsts array<int>, owned array<int>, keys array<long>"
FOUND = "low long, high long, spans array<struct<start:int,end:int>>, prints array<struct<low:long,high:long,at:int>>"
SPANS = "array<struct<start:int,end:int>>"


def words_at(content: np.ndarray) -> np.ndarray:
    """The eight bytes that start at each byte, as one big-endian number (zeros after the end)."""
    padded = np.concatenate([content, np.zeros(16, np.uint8)])
    out = np.empty(len(content) + 8, np.uint64)
    for shift in range(8):
        part = padded[shift:]
        found = part[: len(part) // 8 * 8].view(">u8")
        out[shift::8] = found[: len(out[shift::8])]
    return out[: len(content) + 1]


def anchors(content: np.ndarray, offsets: np.ndarray, length: int = LENGTH, key: int = KEY):
    """Runs of windows that share an anchor: row, first window, windows, key hash."""
    n = len(content)
    width = length - key + 1
    word = words_at(content)[:n]
    after = np.concatenate([word[8:], np.zeros(8, np.uint64)])[:n]
    gram = (word * _ODD) ^ (after * np.uint64(0xD6E8FEB86659FD93))
    gram ^= gram >> np.uint64(29)
    gram *= np.uint64(0xBF58476D1CE4E5B9)
    low = np.uint64((1 << 28) - 1)
    value = (gram & ~low) | np.arange(n, dtype=np.uint64)
    reach = 1
    while reach * 2 <= width:
        value = np.minimum(value[:-reach], value[reach:]) if len(value) > reach else value[:0]
        reach *= 2
    rest = width - reach
    if rest:
        value = np.minimum(value[:-rest], value[rest:]) if len(value) > rest else value[:0]
    windows = np.maximum(np.diff(offsets) - length + 1, 0)
    at = ragged(offsets[:-1], windows)
    row = np.repeat(np.arange(len(windows)), windows)
    anchor = (value[at] & low).astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    place = anchor[first]
    hashed = np.zeros(len(place), np.uint64)
    for step in range(0, key, 8):
        hashed = mix(hashed * np.uint64(3) + word[place + step])
    return row[first], at[first] - offsets[:-1][row[first]], np.diff(np.append(first, len(at))), hashed.view(np.int64)


# Suffix arrays


def suffix_array(content: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Suffixes in order; equal ones by place.

    ``ends`` names, for each byte, where its segment ends: a suffix stops there.
    """
    n = len(content)
    depth = int((ends - np.arange(n)).max(initial=0))
    padded = np.concatenate([content.astype(np.uint64) + np.uint64(1), np.zeros(7, np.uint64)])
    word = np.zeros(n, np.uint64)
    left = ends - np.arange(n)
    for step in range(7):  # seven bytes of nine bits; nothing after the segment's end
        word = (word << np.uint64(9)) | np.where(left > step, padded[step : step + n], np.uint64(0))
    order = np.argsort(word, kind="stable")
    start = np.ones(n, bool)
    start[1:] = word[order][1:] != word[order][:-1]
    group = np.maximum.accumulate(np.where(start, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = group
    reached = 7
    while reached < depth:
        step = min(reached, depth - reached)
        single = start & np.append(start[1:], True)
        slots = np.flatnonzero(~single)
        if not len(slots):
            break
        place = order[slots]
        after = place + step
        second = np.where(after < ends[place], rank[np.minimum(after, n - 1)] + 1, 0)
        if n < 1 << 21:
            packed = (rank[place] << 42) | (second << 21) | place
            packed.sort()
            place = packed & ((1 << 21) - 1)
            packed >>= 21
            change = packed[1:] != packed[:-1]
        else:
            turn = np.lexsort((place, second, rank[place]))
            change = (rank[place][turn][1:] != rank[place][turn][:-1]) | (second[turn][1:] != second[turn][:-1])
            place = place[turn]
        order[slots] = place
        start[slots[1:]] |= change
        group = np.maximum.accumulate(np.where(start, np.arange(n), 0))
        rank[place] = group[slots]
        reached += step
    return order


def common_prefixes(content: np.ndarray, ends: np.ndarray, order: np.ndarray, depth: int = LENGTH, lane: int = 64) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in order, up to ``depth`` (Kasai).

    Kasai's recurrence runs along the text; here it runs in lanes of ``lane`` bytes side by side.
    """
    n = len(content)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    padded = np.concatenate([content, np.zeros(8, np.uint8)])
    word = np.empty(n, np.uint64)
    for shift in range(8):
        part = padded[shift:]
        found = part[: len(part) // 8 * 8].view("<u8")
        word[shift::8] = found[: len(word[shift::8])]
    shared = np.zeros(n, np.int64)
    last = np.zeros(-(-n // lane), np.int64)
    for step in range(lane):
        at = np.arange(step, n, lane)
        other = before[at]
        most = np.where(other >= 0, np.minimum(np.minimum(ends[at] - at, ends[other] - other), depth), 0)
        length = np.minimum(np.maximum(last[: len(at)] - 1, 0), most)
        live = np.flatnonzero(length < most)
        while len(live):
            a, b = at[live] + length[live], other[live] + length[live]
            differ = word[a] ^ word[b]
            lowest = differ & (~differ + np.uint64(1))
            equal = np.where(differ == 0, 8, np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) >> 3)
            length[live] = np.minimum(length[live] + equal, most[live])
            live = live[(equal == 8) & (length[live] < most[live])]
        shared[at] = length
        last[: len(at)] = length
    return shared[order]


def _spans(starts: np.ndarray, rows: np.ndarray, n_rows: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows, sorted by row and start, as maximal spans: row offsets, starts, ends."""
    new = np.ones(len(starts), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (starts[1:] > starts[:-1] + length)
    first = np.flatnonzero(new)
    final = np.append(first[1:], len(starts)) - 1 if len(starts) else first
    return np.searchsorted(rows[first], np.arange(n_rows + 1)), starts[first], starts[final] + length


def _span_lists(offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    pairs = pa.StructArray.from_arrays([pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)


def _search_shard(table: pa.Table, length: int) -> pa.Table:
    """Spans of the windows that repeat among these segments; fingerprints of the others of split keys."""
    content, offsets = text_bytes(table.column("segment"))
    low, high, times, split = (np.asarray(table.column(c)) for c in ("low", "high", "times", "split"))
    ends = np.repeat(offsets[1:], np.diff(offsets))
    order = suffix_array(content, ends)
    shared = common_prefixes(content, ends, order, length)
    run = np.cumsum(shared < length) - 1
    window = np.flatnonzero(ends[order] - order >= length)
    segment = np.searchsorted(offsets, order[window], side="right") - 1
    count = np.bincount(run[window], times[segment], minlength=1)
    repeats = count[run[window]] >= 2
    place, row = order[window][repeats], segment[repeats]
    turn = np.argsort(place)
    spans = _span_lists(*_spans((place - offsets[row])[turn], row[turn], len(low), length))
    # One place of each equal run speaks for it in the other shards; -1 marks one that is settled here.
    speaks = np.ones(len(window), bool)
    speaks[1:] = run[window][1:] != run[window][:-1]
    speaks &= split[segment]
    place, row, settled = order[window][speaks], segment[speaks], repeats[speaks]
    raw = content.tobytes()
    prints = np.frombuffer(b"".join(hashlib.blake2b(raw[a : a + length], digest_size=16).digest() for a in place.tolist()), "<i8").reshape(-1, 2)
    turn = np.argsort(row, kind="stable")
    at = np.where(settled, -1, place - offsets[row])[turn]
    items = pa.StructArray.from_arrays([pa.array(prints[turn, 0]), pa.array(prints[turn, 1]), pa.array(at, pa.int32())], ["low", "high", "at"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[turn], np.arange(len(low) + 1)), pa.int32()), items)
    return pa.table({"low": pa.array(low), "high": pa.array(high), "spans": spans, "prints": lists})


def _merge_shards(table: pa.Table, length: int) -> pa.Table:
    """Windows of split keys that more than one shard holds, found by binary search among all prints."""
    both = np.rec.fromarrays([np.asarray(table.column("print_low")), np.asarray(table.column("print_high"))])
    ordered = np.sort(both)
    times = np.searchsorted(ordered, both, side="right") - np.searchsorted(ordered, both)
    at = np.asarray(table.column("at"))
    found = np.flatnonzero((times > 1) & (at >= 0))
    spans = _span_lists(np.arange(len(found) + 1), at[found], at[found] + length)
    return pa.table({"low": table.column("low").take(pa.array(found)), "high": table.column("high").take(pa.array(found)), "spans": spans})


# Scans


def _scan(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    number = itertools.count(TaskContext.get().partitionId() << 36)
    for batch in batches:
        for part in sliced(batch, "text"):
            content, offsets = text_bytes(part.column("text"))
            row, first, _, keys = anchors(content, offsets, length, min(KEY, length // 2 // 8 * 8))
            bounds = np.searchsorted(row, np.arange(part.num_rows + 1))
            order = np.lexsort((keys, row))
            same = np.flatnonzero((keys[order][1:] == keys[order][:-1]) & (row[order][1:] == row[order][:-1]))
            twice, twice_row = keys[order][same], row[order][same]  # keys that one document has more than once
            raw = content.tobytes()
            sha = [hashlib.sha256(raw[a:b]).digest() for a, b in itertools.pairwise(offsets.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(number) for _ in sha], pa.int64()), part.column("doc_id"), pa.array(np.diff(offsets)),
                    pa.array(sha, pa.binary()), list_array(first.astype(np.int32), bounds), list_array(keys, bounds),
                    list_array(twice, np.searchsorted(twice_row, np.arange(part.num_rows + 1))),
                ],
                ["row", "doc_id", "n_bytes", "sha", "firsts", "keys", "own"],
            )


def _suspects(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in sliced(batch, "text"):
            rows = []
            for row in part.to_pylist():
                raw = row["text"].encode()
                if hashlib.sha256(raw).digest() != row["sha"]:
                    continue  # another text with the same id
                firsts = np.array(row["firsts"])
                owned = np.diff(np.append(firsts, len(raw) - length + 1))
                keys = np.array(row["keys"])
                again = np.isin(keys, row["again"])
                rows.append((row["row"], raw, firsts[again], owned[again], keys[again]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())]
                    + [pa.array([r[k] for r in rows], t) for k, t in ((2, pa.list_(pa.int32())), (3, pa.list_(pa.int32())), (4, pa.list_(pa.int64())))],
                    ["row", "text", "firsts", "owned", "keys"],
                )


def _segments(batches: Iterator[pa.RecordBatch], length: int, content: bool) -> Iterator[pa.RecordBatch]:
    """Segments with their 128-bit digest; with their bytes, or with the place they come from."""
    for batch in batches:
        for part in sliced(batch, "text", 1 << 20):
            raws = part.column("text").to_pylist()
            firsts, owned, keys = (part.column(c) for c in ("firsts", "owned", "keys"))
            count = np.asarray(firsts.value_lengths()).astype(np.int64)
            first, size = np.asarray(firsts.flatten()), np.asarray(owned.flatten()) + length - 1
            doc = np.repeat(np.arange(len(raws)), count)
            pieces = [raws[d][a : a + n] for d, a, n in zip(doc.tolist(), first.tolist(), size.tolist(), strict=True)]
            digests = np.frombuffer(b"".join(hashlib.blake2b(p, digest_size=16).digest() for p in pieces), "<i8").reshape(-1, 2)
            columns = [pa.array(digests[:, 0]), pa.array(digests[:, 1])]
            if content:
                columns += [pa.array(np.asarray(keys.flatten())), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["low", "high", "key", "segment"])
            else:
                columns += [part.column("row").take(pa.array(doc)), pa.array(first, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["low", "high", "row", "first"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text without its spans."""
    for batch in batches:
        for part in sliced(batch, "text"):
            out = []
            for row, raw, spans in zip(*(part.column(c).to_pylist() for c in ("row", "text", "spans")), strict=True):
                merged: list[list[int]] = []
                for start, end in sorted((s["start"], s["end"]) for s in spans):
                    if merged and start <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], end)
                    else:
                        merged.append([start, end])
                kept = hashlib.sha256()
                at = 0
                for a, b in merged:
                    kept.update(raw[at:a])
                    at = b
                kept.update(raw[at:])
                out.append((row, sum(b - a for a, b in merged), merged, kept.digest()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()),
                    pa.array([[{"start": a, "end": b} for a, b in o[2]] for o in out], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array([o[3] for o in out], pa.binary()),
                ],
                ["row", "removed", "spans", "kept"],
            )


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, spans, kept_sha256``."""
    spark = docs.sparkSession
    if length < 32:
        raise ValueError("length must be 32 or more")
    rows = texts(docs).select(id_key().alias("doc_id"), "text")
    scan = stored(rows.mapInArrow(lambda b: _scan(b, length), SCAN), "anchors")
    classes = stored(
        scan.groupBy("sha").agg(F.min("row").alias("row"), F.count(F.lit(1)).alias("copies"), F.min("n_bytes").alias("n_bytes")), "classes"
    )
    one = scan.join(classes.select("row"), "row", "left_semi")
    keyed = one.select("row", F.explode(F.array_distinct("keys")).alias("key")).repartition("key")
    again = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
    listed = keyed.join(again.hint("shuffle_hash"), "key").groupBy("row").agg(F.collect_list("key").alias("_again"))
    known = (
        one.join(listed, "row", "left")
        .withColumn("again", F.concat(F.coalesce("_again", F.array().cast("array<long>")), "own"))
        .where(F.size("again") > 0)
    )
    found = rows.join(known, "doc_id").select("text", "row", "sha", "firsts", "keys", "again")
    name = f"suspects_{uuid.uuid4().hex[:12]}"
    (
        found.mapInArrow(lambda b: _suspects(b, length), SUSPECT)
        .write.option("path", run_dir(spark, "suspects"))
        .option("compression", "zstd")
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "row")
        .saveAsTable(name)
    )
    suspects = spark.table(name)

    different = stored(
        suspects.mapInArrow(lambda b: _segments(b, length, True), "low long, high long, key long, segment binary")
        .groupBy("key", "low", "high", "segment")
        .agg(F.count(F.lit(1)).alias("times")),
        "segments",
    )
    per_key = different.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    alone = different.join(per_key.where("_n = 1").select("key"), "key", "left_semi")  # nothing to sort: every window repeats
    size = different.agg(F.sum(F.length("segment"))).first()[0] or 0
    shards = max(1, -(-size // SHARD))
    dealt = (
        different.join(per_key.where("_n > 1"), "key")
        .withColumn("split", F.col("_n") > MOST)
        .withColumn("_salt", F.pmod(F.xxhash64("low"), F.ceil(F.col("_n") / MOST)))
        .withColumn("shard", F.pmod(F.xxhash64("key", "_salt"), F.lit(shards)))
        .select("shard", "low", "high", "segment", "times", "split")
    )
    searched = stored(dealt.groupBy("shard").applyInArrow(lambda t: _search_shard(t, length), FOUND), "searched")
    prints = searched.select("low", "high", F.inline("prints").alias("print_low", "print_high", "at"))
    merged = (
        prints.withColumn("_bucket", F.pmod(F.xxhash64("print_low"), F.lit(shards)))
        .groupBy("_bucket")
        .applyInArrow(lambda t: _merge_shards(t, length), f"low long, high long, spans {SPANS}")
    )
    whole = F.array(F.struct(F.lit(0).alias("start"), F.length("segment").alias("end"))).cast(SPANS)
    repeats = (
        searched.select("low", "high", "spans")
        .unionByName(merged)
        .unionByName(alone.select("low", "high", whole.alias("spans")))
        .where(F.size("spans") > 0)
    )
    places = suspects.mapInArrow(lambda b: _segments(b, length, False), "low long, high long, row long, first int")
    moved = F.transform("spans", lambda s: F.struct((s["start"] + F.col("first")).alias("start"), (s["end"] + F.col("first")).alias("end")))
    per_row = places.join(repeats, ["low", "high"]).select("row", moved.alias("spans")).groupBy("row").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    cut = suspects.select("row", "text").join(per_row, "row").mapInArrow(_cut, f"row long, removed long, spans {SPANS}, kept binary")

    copied = (F.col("copies") > 1) & (F.col("n_bytes") >= length)
    everything = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end"))).cast(SPANS)
    # Rows that repeat both id and text were joined with each other: one outcome for the class.
    outcome = classes.join(cut.dropDuplicates(["row"]), "row", "left").select(
        "sha",
        F.when(copied, F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(copied, everything).otherwise(F.coalesce("spans", F.array().cast(SPANS))).alias("spans"),
        F.when(copied, F.unhex(F.sha2(F.lit(""), 256))).otherwise(F.coalesce("kept", "sha")).alias("_kept"),
    )
    return scan.select("doc_id", "n_bytes", "sha").join(outcome, "sha").select(
        id_value("doc_id").alias("doc_id"), "n_bytes", "n_removed", "spans", F.lower(F.hex("_kept")).alias("kept_sha256")
    )


def suffix_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    return repeated_spans(docs, length).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
