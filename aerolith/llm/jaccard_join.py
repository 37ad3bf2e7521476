"""N-gram Jaccard self-join by a token-group matrix.

A document's set holds its distinct word shingles (with fewer words than ``words`` the whole sequence is one;
without words the set is empty and links with nothing). Two documents link when
``limit[1] * |A and B| >= limit[0] * |A or B|``; components follow links.

1. Equal sets are one class from the start, so exact copies cost one row each.
2. Every class has a prefix: its rarest shingles, so many that two linked classes share at least ``need`` of them.
   Any order that all classes have in common is exact; this one goes by how often the words of a shingle occur (the
   rarest word, then all of them, then the hash), so that classes do not meet by frequent words. A class whose prefix
   meets the prefixes of *all* others in fewer shingles cannot qualify for any group and leaves; so does one that
   falls short within its band of set sizes. The rarest shared shingles of those left, all but ``need - 1``,
   connect classes of a band into groups: linked classes are always in one group, and no pair is emitted.
3. A group is stored in blocks of bounded size: the union of its shingles and, for each member, its row of
   the token-group matrix (places in that union). The pairs of blocks of a large group are dealt as square tiles:
   a task takes the blocks of two edges of a tile, so with B blocks in a group each block is sent about
   sqrt(B) times (B / TILE times in a group of more than TILE^2 blocks), and tiles spread over all tasks.
4. In a pair of blocks each member of one is a query: its overlap with the other's union bounds its
   overlap with any member; only where the bound reaches the limit the block is opened and
   overlaps are counted exactly. A tile returns one row per member that links: an edge and its link count.

Nothing is capped or sampled. Shingles are compared as 64-bit hashes and sets as 128-bit hashes. Within one
group of N near copies the work is N^2 / (members per block) bounds; elsewhere it follows the input.
Null ids stand last and are returned as null; repeated rows are copies of each other. Of a component ``keep_one`` keeps
one row: with the smallest id, of rows that share it one text, of equal rows any; rows without words all stay.
An empty table gives an empty result.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerolith.llm import matrices
from aerolith.llm.arrays import SPACES, hash_terms, list_array, mix, ragged, sliced, split_words, text_bytes
from aerolith.llm.components import components
from aerolith.llm.tables import id_key, id_value, stored, texts

MEMBERS = 256
SHINGLES = 1 << 17
TILE = 16
CELL_BITS = 20
SKETCH = "row long, doc_id long, mark long, n_shingles long, class binary, need int, prefix array<long>"
GROUP = "group long, block int, n_blocks int, classes binary, copies binary, sizes binary, shingles binary, matrix binary"
LINKS = "class long, with long, n_links long"


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << CELL_BITS, np.int64)
    for batch in batches:
        for part in sliced(batch, "text"):
            split = split_words(*text_bytes(part.column("text")), SPACES)
            if len(split.codes):
                total += np.bincount(_cell(hash_terms(split.terms))[split.codes], minlength=len(total))
    yield from matrices.blocks("words", total)


def _cell(hashed: np.ndarray) -> np.ndarray:
    return (hashed >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def word_levels(docs: DataFrame) -> np.ndarray:
    """How often the words of each hash cell occur in all texts, in quarters of a power of two: one table of fixed size."""
    found = matrices.gathered(docs.select("text").mapInArrow(_word_counts, matrices.BLOCKS), 1 << CELL_BITS)
    return np.rint(4 * np.log2(1 + found.get("words", np.zeros(1 << CELL_BITS, np.int64)))).astype(np.uint8)


class ShingleSets:
    """Sorted distinct shingle hashes of each row of a text column; with ``levels`` of words also the order of a prefix."""

    def __init__(self, column: pa.Array, words: int, levels: np.ndarray | None = None):
        from xxhash import xxh3_128_digest

        split = split_words(*text_bytes(column), SPACES)
        count = np.diff(split.rows)
        size = np.where(count > 0, np.maximum(count - words + 1, 1), 0)
        at = ragged(split.rows[:-1], size)
        last = np.repeat(split.rows[1:], size)
        hashed = hash_terms(split.terms)[split.codes] if len(split.codes) else np.zeros(1, np.uint64)
        value = np.full(len(at), 1, np.uint64)
        for step in range(words):
            place = at + step
            word = np.where(place < last, hashed[np.minimum(place, len(hashed) - 1)], np.uint64(0))
            value = mix(value * np.uint64(3) + word)
        ends = np.cumsum(size)
        spans = list(zip((ends - size).tolist(), ends.tolist(), strict=True))
        if levels is None:
            for a, b in spans:
                value[a:b].sort()
        else:
            order = np.concatenate([np.zeros(0, np.int64), *(a + np.argsort(value[a:b]) for a, b in spans)])
            level, least, total = levels[_cell(hashed)].astype(np.int64), np.full(len(at), 255), np.zeros(len(at), np.int64)
            for step in range(words):
                place = at + step
                word = level[np.minimum(place, len(level) - 1)]
                least = np.where(place < last, np.minimum(least, word), least)
                total += np.where(place < last, word, 0)
            rarity = ((least << 16) | np.minimum(total, 0xFFFF)).astype(np.uint64)[order]
            value = value[order]
        new = np.ones(len(value), bool)
        new[1:] = value[1:] != value[:-1]
        new[(ends - size)[size > 0]] = True
        self.values = value[new].view(np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(new)])[np.concatenate([[0], ends])]
        self.sizes = np.diff(self.offsets)
        if levels is not None:
            # Ties go by the whole hash: values are sorted, and a prefix sorts its keys stably.
            self.keys = (rarity[new] << np.uint64(40)) | (value[new] >> np.uint64(24))
        raw = self.values.tobytes()
        self.classes = [
            xxh3_128_digest(raw[8 * a : 8 * b]) if b > a else None
            for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist(), strict=True)
        ]

    def rarest(self, length: np.ndarray) -> np.ndarray:
        """The first ``length`` values of each row in the order that all rows have in common."""
        spans = zip(self.offsets[:-1].tolist(), length.tolist(), self.offsets[1:].tolist(), strict=True)
        places = [a + np.argsort(self.keys[a:b], kind="stable")[:n] for a, n, b in spans]
        return self.values[np.concatenate([np.zeros(0, np.int64), *places])]


def _extra(size: np.ndarray, limit: tuple[int, int]) -> np.ndarray:
    """How many prefix shingles linked classes share at least, by the smaller size."""
    return 1 + size * (limit[1] - limit[0]) // (2 * limit[1])


def _sketches(batches: Iterator[pa.RecordBatch], words: int, limit: tuple[int, int], levels: np.ndarray) -> Iterator[pa.RecordBatch]:
    number = itertools.count(TaskContext.get().partitionId() << 36)
    for batch in batches:
        for part in sliced(batch, "text"):
            sets = ShingleSets(part.column("text"), words, levels)
            least = -(-sets.sizes * limit[0] // limit[1])  # shingles that any linked set shares
            length = np.minimum(sets.sizes - least + _extra(sets.sizes, limit), sets.sizes)
            # A linked set has at least ``least`` shingles itself; so much is shared inside both prefixes.
            need = np.minimum(_extra(least, limit), np.maximum(least, 1))
            flat = sets.rarest(length)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([next(number) for _ in range(part.num_rows)], pa.int64()), part.column("doc_id"), part.column("mark"),
                    pa.array(sets.sizes), pa.array(sets.classes, pa.binary()), pa.array(need, pa.int32()),
                    list_array(flat, np.concatenate([[0], np.cumsum(length)])),
                ],
                ["row", "doc_id", "mark", "n_shingles", "class", "need", "prefix"],
            )


def _size_band(size: str, limit: tuple[int, int]) -> Column:
    """Bands of set sizes: a set and any larger one that it can link with are at most one band apart."""
    return F.floor(F.log(F.col(size).cast("double")) / F.lit(math.log(limit[1] / limit[0]) * 1.0001)).cast("int")


def _groups(sketches: DataFrame, classes: DataFrame, limit: tuple[int, int]) -> DataFrame:
    """``class, group`` of the classes that may link with another one."""
    # Only sets of like size can link, so all counts are within bands of sizes, each set in its own and the next: a band
    # counts its own sets and those one band below. One shuffle by shingle serves all bands, one row a class and shingle goes on.
    like = Window.partitionBy("shingle").orderBy("_band")
    # Differences of running counts: such windows hold no rows, however many share a shingle.
    upto = [F.count(F.lit(1)).over(like.rangeBetween(Window.unboundedPreceding, n)) for n in (-2, -1, 0, 1)]
    counted = (
        sketches.join(classes.select(F.col("_class").alias("row")), "row", "left_semi")
        .withColumn("_band", _size_band("n_shingles", limit))
        .select(F.col("row").alias("class"), "need", "_band", F.explode("prefix").alias("shingle"))
        .select("*", (upto[2] - upto[0]).alias("_own"), (upto[3] - upto[1]).alias("_next"))
        .where("_own > 1 OR _next > 1")
    )
    bands = F.array(F.struct(F.col("_band").alias("band"), F.col("_own").alias("_held")), F.struct((F.col("_band") + 1).alias("band"), F.col("_next").alias("_held")))
    held = (
        counted.repartition("class")
        .withColumn("_at", F.explode(bands))
        .select("class", "shingle", "need", "_at.*")
        .where("_held > 1")
    )
    one = Window.partitionBy("class", "band")
    rare = stored(
        held.withColumn("_size", F.count(F.lit(1)).over(one))
        .withColumn("_nth", F.row_number().over(one.orderBy("_held", "shingle")))
        .where("_size >= need AND _nth <= _size - need + 1")
        .select("class", "band", "shingle"),
        "rare",
    )
    first = rare.groupBy("band", "shingle").agg(F.min("class").alias("_first"))
    # All first classes that a class meets are one component: they are tied to the smallest of them, which many
    # classes of a large group have in common, and so is the class. Edges stay about as many as classes.
    met = rare.join(first, ["band", "shingle"]).select("class", "_first").distinct()
    tied = met.withColumn("a", F.min("_first").over(Window.partitionBy("class")))
    edges = (
        tied.select("a", F.col("_first").alias("b"))
        .unionByName(tied.select("a", F.col("class").alias("b")))
        .where("a < b")
        .distinct()
    )
    return components(edges).select(F.col("node").alias("_class"), F.col("root").alias("group"))


def _blocks(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """Blocks of the groups, stored: the token-group matrix."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in sliced(batch, "text"):
                found = ShingleSets(part.column("text"), words)
                same = np.array([c == k for c, k in zip(found.classes, part.column("class").to_pylist(), strict=True)], bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column("group"), part.column("block"), part.column("n_blocks"), part.column("_class"), part.column("copies"), list_array(found.values, found.offsets)],
                    ["group", "block", "n_blocks", "class", "copies", "shingles"],
                ).filter(pa.array(same))

    def block(key: tuple, table: pa.Table) -> pa.Table:
        classes, rows = np.unique(np.asarray(table.column("class")), return_index=True)
        table = table.take(pa.array(rows))
        lists = table.column("shingles").combine_chunks()
        sizes = np.asarray(lists.value_lengths()).astype(np.int64)
        union, places = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        blobs = (classes, np.asarray(table.column("copies")), sizes, union, places)
        kinds = ("<i8", "<i8", "<i4", "<i8", "<i4")
        return pa.table(
            [pa.array([key[0].as_py()], pa.int64()), pa.array([key[1].as_py()], pa.int32()), table.column("n_blocks").slice(0, 1)]
            + [pa.array([b.astype(k).tobytes()], pa.binary()) for b, k in zip(blobs, kinds, strict=True)],
            ["group", "block", "n_blocks", "classes", "copies", "sizes", "shingles", "matrix"],
        )

    heavy = members.groupBy("group").agg(F.count(F.lit(1)).alias("_n"), F.sum("n_shingles").alias("_s"))
    blocks = F.greatest(F.ceil(F.col("_n") / MEMBERS), F.ceil(F.col("_s") / SHINGLES))
    dealt = (
        members.join(heavy, "group")
        .withColumn("n_blocks", blocks.cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("_class"), F.col("n_blocks")).cast("int"))
        .select("doc_id", "class", "_class", "copies", "group", "block", "n_blocks")
    )
    # Texts are shuffled whatever the number of members, so the cost per document is the same at every size.
    rows = texts(docs).select(id_key().alias("doc_id"), "text").join(dealt.hint("merge"), "doc_id").select("text", "class", "_class", "copies", "group", "block", "n_blocks")
    filled = rows.mapInArrow(sets, "group long, block int, n_blocks int, class long, copies long, shingles array<long>")
    return stored(filled.groupBy("group", "block").applyInArrow(block, GROUP), "blocks", **{"parquet.block.size": str(32 << 20)})


class Block:
    def __init__(self, row: dict):
        def read(name: str, kind: str) -> np.ndarray:
            return np.frombuffer(row[name], kind).astype(np.int64)

        self.classes, self.copies, self.sizes = read("classes", "<i8"), read("copies", "<i8"), read("sizes", "<i4")
        self.union, self.places = read("shingles", "<i8"), read("matrix", "<i4")
        self.begins = np.cumsum(self.sizes) - self.sizes

    def links(self, other: Block, limit: tuple[int, int]) -> Iterator[tuple[int, np.ndarray]]:
        """Each member of this block with the members of ``other`` it links with."""
        at = np.minimum(np.searchsorted(other.union, self.union), len(other.union) - 1)
        common = np.where(other.union[at] == self.union, at, -1)[self.places]
        bound = np.add.reduceat(common >= 0, self.begins, dtype=np.int64)
        marked = np.zeros(len(other.union), bool)
        for i in np.flatnonzero(bound * limit[1] >= self.sizes * limit[0]).tolist():
            mine = common[self.begins[i] : self.begins[i] + self.sizes[i]]
            mine = mine[mine >= 0]
            marked[mine] = True
            both = np.add.reduceat(marked[other.places], other.begins, dtype=np.int64)
            marked[mine] = False
            yield i, np.flatnonzero(both * limit[1] >= (self.sizes[i] + other.sizes - both) * limit[0])


class Tile:
    """Link counts of the members of some blocks, and for each the smallest place it is connected with."""

    def __init__(self, blocks: list[Block]):
        self.blocks = blocks
        self.begins = np.cumsum([0, *(len(b.classes) for b in blocks)])
        self.root, self.count = np.arange(self.begins[-1]), np.zeros(self.begins[-1], np.int64)

    def meet(self, a: int, b: int, limit: tuple[int, int]) -> None:
        left, right = self.blocks[a], self.blocks[b]
        for i, found in left.links(right, limit):
            if a == b:
                found = found[found > i]
            if len(found):
                one, many = self.begins[a] + i, self.begins[b] + found
                self.count[one] += right.copies[found].sum()
                self.count[many] += left.copies[i]
                known = np.append(self.root[many], self.root[one])
                low = known.min()
                if (known != low).any():
                    self.root[np.isin(self.root, known)] = low

    def result(self) -> pa.Table:
        classes = np.concatenate([b.classes for b in self.blocks])
        linked = np.flatnonzero(self.count)
        return pa.table([pa.array(classes[linked]), pa.array(classes[self.root[linked]]), pa.array(self.count[linked])], ["class", "with", "n_links"])


def _alone(batches: Iterator[pa.RecordBatch], limit: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Links within groups of one block."""
    for batch in batches:
        for n in range(batch.num_rows):
            tile = Tile([Block(batch.slice(n, 1).to_pylist()[0])])
            tile.meet(0, 0, limit)
            yield from tile.result().to_batches()


def _tiles(blocks: DataFrame, limit: tuple[int, int]) -> DataFrame:
    """Links within groups of several blocks: every pair of blocks is met in one tile."""
    side = F.least(F.lit(TILE), F.ceil(F.sqrt("n_blocks"))).cast("int")
    edge = F.floor(F.col("block") / F.col("_side")).cast("int")
    every = F.sequence(F.lit(0), F.floor((F.col("n_blocks") - 1) / F.col("_side")).cast("int"))
    tiles = F.transform(every, lambda v: F.struct(F.least(v, F.col("_edge")).alias("low"), F.greatest(v, F.col("_edge")).alias("high")))
    dealt = blocks.withColumn("_side", side).withColumn("_edge", edge).withColumn("_tile", F.explode(tiles)).select("*", "_tile.*")
    keys = ["group", "low", "high"]

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        rows = table.to_pylist()
        tile = Tile([Block(row) for row in rows])
        for a, one in enumerate(rows):
            for b, other in enumerate(rows):
                if one["_edge"] == low and other["_edge"] == high and (low < high or one["block"] <= other["block"]):
                    tile.meet(a, b, limit)
        return tile.result()

    # As many partitions as shuffles have: a tile costs time by its pairs, not its bytes.
    number = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return dealt.drop("_tile", "_side").repartition(number, *keys).groupBy(*keys).applyInArrow(meet, LINKS)


def _resolved(docs: DataFrame, words: int, limit: tuple[int, int]) -> DataFrame:
    """One row per document: its id, the hash of its text, its class and component (null without words) and its links."""
    rows = texts(docs).select(id_key().alias("doc_id"), F.xxhash64("text").alias("mark"), "text")
    levels = docs.sparkSession.sparkContext.broadcast(word_levels(rows))
    sketches = stored(rows.mapInArrow(lambda b: _sketches(b, words, limit, levels.value), SKETCH), "sketches")
    classes = stored(
        sketches.where("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("row").alias("_class"), F.min("doc_id").alias("_least"), F.min("n_shingles").alias("n_shingles"),
            F.count(F.lit(1)).alias("copies"),
        ),
        "classes",
    )
    grouped = _groups(sketches, classes, limit)
    members = stored(
        grouped.join(classes, "_class").select(F.col("_least").alias("doc_id"), "class", "_class", "n_shingles", "copies", "group"), "members"
    )
    blocks = _blocks(docs, members, words)
    alone = blocks.where("n_blocks = 1").mapInArrow(lambda b: _alone(b, limit), LINKS)
    links = stored(alone.unionByName(_tiles(blocks.where("n_blocks > 1"), limit)), "links")
    linked = links.groupBy(F.col("class").alias("_class")).agg(F.sum("n_links").alias("_links"))
    joined = components(links.where(F.col("class") != F.col("with")), "class", "with").select(F.col("node").alias("_class"), F.col("root").alias("_root"))
    placed = classes.join(joined, "_class", "left").join(linked, "_class", "left").withColumn("_root", F.coalesce("_root", "_class"))
    least = placed.groupBy("_root").agg(F.min("_least").alias("_component"))
    known = placed.join(least, "_root").select("class", "_root", "_component", (F.col("copies") - 1 + F.coalesce("_links", F.lit(0))).alias("_n"))
    return sketches.select("doc_id", "mark", "n_shingles", "class").join(known, "class", "left")


def jaccard_components(docs: DataFrame, words: int = 5, limit: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, n_links`` (copies count as linked)."""
    return _resolved(docs, words, limit).select(
        id_value("doc_id").alias("doc_id"),
        "n_shingles",
        F.when(F.col("class").isNull(), id_value("doc_id")).otherwise(id_value("_component")).alias("component_id"),
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"),
    )


def keep_one(docs: DataFrame, words: int = 5, limit: tuple[int, int] = (80, 100)) -> DataFrame:
    """One row of each component of ``docs`` and all rows without words, with all their columns.

    Rows are told apart by id and text: of a component's rows with its smallest id (null stands last) the one whose
    text has the smallest hash stays, and of rows equal in both, one.
    """
    found = _resolved(docs, words, limit).where("_root IS NULL OR doc_id = _component")
    rows = found.groupBy("_root", "doc_id", "mark").agg(F.count(F.lit(1)).alias("_copies"))
    first = Window.partitionBy("_root").orderBy("mark")
    kept = rows.where("_root IS NOT NULL").withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")
    keys = stored(
        kept.unionByName(rows.where("_root IS NULL").withColumn("_copies", F.lit(1).cast("long")))
        .select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), "_copies"),
        "kept",
    )
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select(F.struct("*").alias("_row"), id_key().alias("_id"), F.xxhash64(text).alias("_mark"))
    single = keyed.join(keys.where("_copies = 1"), ["_id", "_mark"], "left_semi").select("_row.*")
    repeated = keys.where("_copies > 1")
    if repeated.isEmpty():
        return single
    copies = keyed.join(repeated, ["_id", "_mark"], "left_semi")
    one = Window.partitionBy("_id", "_mark").orderBy(F.lit(0))
    return single.unionByName(copies.withColumn("_nth", F.row_number().over(one)).where("_nth = 1").select("_row.*"))


SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS s
  FROM words, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared s JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * s.n >= 90 * (p.n + q.n - s.n)
), reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (SELECT x, min(y) AS y FROM reach GROUP BY x
), counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(least(doc_id, least.y), doc_id) AS component_id, coalesce(c.n, 0) AS n_links
FROM words LEFT JOIN sizes z USING (doc_id) LEFT JOIN least ON least.x = doc_id LEFT JOIN counted c ON c.x = doc_id
"""
