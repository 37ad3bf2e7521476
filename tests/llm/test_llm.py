"""Training-data operators against brute force, on the smallest driver data and on edge rows."""

from __future__ import annotations

import hashlib
import itertools
import math
import os
import random
import re
import tracemalloc
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aerolith.llm import (
    decontaminate,
    exact_dedup,
    fuzzy_passages,
    jaccard_join,
    language,
    packing,
    quality,
    queries,
    suffix_dedup,
    token_store,
    transcripts,
)
from aerolith.llm.bpe import Encoder, vocabulary_path
from aerolith.llm.components import components
from aerolith.llm.packed import pack, unpack
from aerolith.llm.tables import table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver data not present")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, _id long, row int"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DATA, "documents").cache()


@pytest.fixture(scope="module")
def raw(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, ties, columns with clashing names."""
    passage = " ".join(f"word{i}" for i in range(60))
    texts = {
        1: None, 2: "", 3: " \n\t", 4: passage, 5: passage, 6: passage.upper() + " tail", 7: "a", 8: "ab " * 4000,
        9: "x" * 5000, 10: "Привет мир 日本語 😀 <|endoftext|>", 11: "start " + passage + " end", 12: passage + "\n",
    }
    rows = [(i, t, "en" if i % 2 else None, None, i, i, i, i) for i, t in texts.items()]
    rows += [rows[3], rows[3], (None, passage, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _duck(sql):
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(DATA):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{name}'")
    answer = con.execute(sql)
    return [d[0] for d in answer.description], answer.fetchall()


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_matches_oracle(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    names, rows = _duck(queries.ORACLES[name])
    columns = sorted(names)
    assert sorted(df.columns) == columns
    got = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    assert got == sorted(repr(tuple(r[names.index(c)] for c in columns)) for r in rows)


def test_pieces_of_the_vocabulary_are_cut_as_its_pattern_says():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary_path())
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'ll", "a", "é", "1", "½", "!", "$$", "日本", "😀", "<|endoftext|>", "\x85", "\x1c", "'re", "don't"]
    rng = random.Random(5)
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 20))) for _ in range(3000)]
    ids, offsets = Encoder(vocabulary_path()).encode(texts)
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids


def _encoded(raw, end):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(vocabulary_path())
    return {i: [*plain.encode(t or "", add_special_tokens=False).ids, end] for i, t in raw.items()}


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4"))


def test_token_store_reads_back_every_document(docs, raw):
    want, at = {}, 0
    for i, ids in sorted(_encoded(raw, 2).items()):
        want[i] = (at, len(ids), _crc(ids))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.store_digest(docs).collect()}
    assert got == want


def test_keyed_access_refuses_unknown_keys_and_returns_ids(spark, docs, raw):
    shards = token_store.write_shards(docs)
    index = token_store.build_index(shards)
    keys = spark.createDataFrame([(3, 0), (5, 0), (10**12, 0), (3, 1)], "doc_id long, nth long")
    got = {(r.doc_id, r.nth): r.ids for r in token_store.read_keys(shards, index, keys).collect()}
    ids = _encoded({k: raw[k] for k in (3, 5)}, 2)
    assert got == {(3, 0): ids[3], (5, 0): ids[5]}


def test_one_key_opens_one_shard(spark, docs, monkeypatch):
    monkeypatch.setattr(token_store, "SHARD_IDS", 2000)
    monkeypatch.setattr(token_store, "KEYS_PER_BUCKET", 20)
    whole = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_store.store_digest(docs).collect()}
    shards = token_store.write_shards(docs.repartition(8))
    index = token_store.build_index(shards)
    read = token_store.read_keys(shards, index, spark.createDataFrame([(7, 0)], "doc_id long, nth long"))
    (row,) = read.collect()
    assert (row.start, row.n_tokens, row.ids_crc32) == whole[7]
    plan = read._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "payload" in line and "Scan" in line)
    assert "part" in scan.split("PartitionFilters: [")[1].split("]")[0] and "SelectedBucketsCount: 1 out of" in scan and "shard" in scan.split("PushedFilters")[1]
    monkeypatch.setattr(token_store, "FEW", 1)
    many = token_store.read_keys(shards, index, docs.select("doc_id", F.lit(0).cast("long").alias("nth")), with_ids=False)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in many.collect()} == whole
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan
    starts = token_store.shard_starts(shards)
    at, want = 0, {}
    for r in shards.select("shard", "n_ids").orderBy("shard").collect():
        want[r.shard], at = at, at + r.n_ids
    assert {r.shard: r.first for r in starts.collect()} == want


def test_perfect_hash_is_minimal():
    hashes = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64))
    slots = token_store._slots(hashes, token_store.perfect_hash(hashes), len(hashes))
    assert sorted(slots.tolist()) == list(range(len(hashes)))


def test_packing_covers_every_id_once(docs, raw):
    rows = packing.pack_documents(docs).collect()
    ids = _encoded(raw, 0)
    pieces = {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
    for i, want in ids.items():
        mine = sorted(pieces[i], key=lambda r: r.piece)
        assert [x for r in mine for x in r.ids] == want
        assert [r.start for r in mine] == list(np.cumsum([0, *(r.length for r in mine)])[:-1])
        assert all(r.length == 2048 for r in mine[1:]) and all(r.ids_crc32 == _crc(r.ids) for r in mine)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for placed in sequences.values():
        placed.sort()
        assert [o for o, _ in placed] == list(np.cumsum([0, *(n for _, n in placed)])[:-1])
        assert sum(n for _, n in placed) <= 2048
    assert len(sequences) <= 1.03 * sum(map(len, ids.values())) / 2048 + 1


def test_best_fit_keeps_every_capacity():
    sizes = np.sort(np.random.default_rng(2).integers(1, 900, 500))[::-1]
    bins, offsets = packing.best_fit(sizes, 1000, 3, 900_000)
    for b in set(bins.tolist()):
        held = sizes[bins == b]
        assert held.sum() <= 1000 and len(held) <= 3 and (held**2).sum() <= 900_000
        assert sorted(offsets[bins == b].tolist()) == np.cumsum([0, *held[np.argsort(offsets[bins == b])]])[:-1].tolist()


def test_colliding_hashes_stay_apart(docs):
    """A hash of four bits forces collisions; bytes decide."""
    from pyspark.sql import functions as F

    weak = exact_dedup.exact_groups(docs, lambda text: F.substring(F.md5(text), 1, 1))
    columns = sorted(weak.columns)
    assert sorted(weak.select(columns).collect()) == sorted(exact_dedup.exact_groups(docs).select(columns).collect())


def _suffix_brute(raw, length):
    data = {i: (t or "").encode() for i, t in raw.items()}
    seen = Counter(x[p : p + length] for x in data.values() for p in range(len(x) - length + 1))
    out = {}
    for i, x in data.items():
        gone = np.zeros(len(x) + 2, bool)
        for p in range(len(x) - length + 1):
            if seen[x[p : p + length]] > 1:
                gone[p + 1 : p + length + 1] = True
        kept = bytes(b for b, g in zip(x, gone[1:-1], strict=True) if not g)
        out[i] = (len(x), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("most", [2, 2048])
def test_suffix_arrays_find_every_repeated_window(docs, raw, monkeypatch, most):
    monkeypatch.setattr(suffix_dedup, "MOST", most)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_digest(docs).collect()}
    assert got == _suffix_brute(raw, 200)


def test_kasai_lanes_agree_with_plain_comparison():
    rng = np.random.default_rng(4)
    base = rng.integers(97, 100, 90).astype(np.uint8)
    parts = [np.roll(base, k) for k in range(20)]
    content, ends = np.concatenate(parts), np.repeat(np.arange(1, 21) * 90, 90)
    order = suffix_dedup.suffix_array(content, ends)
    suffixes = [content[p : ends[p]].tobytes() for p in order]
    assert suffixes == sorted(suffixes)
    for a, b, n in zip(suffixes, suffixes[1:], suffix_dedup.common_prefixes(content, ends, order)[1:], strict=False):
        assert n == len(os.path.commonprefix([a, b]))


def test_near_copies_at_the_pipeline_threshold(docs, raw):
    sets = {}
    for i, t in raw.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs).collect()}
    assert got == {i: (len(s), find(i)) for i, s in sets.items()}


def test_large_groups_are_met_block_by_block(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MEMBERS", 4)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(base[:i] + [f"z{i}"] + base[i + 1 :])) for i in range(40)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, (90, 100)).collect()
    assert {r.component_id for r in got} == {0} and all(r.n_links >= 1 for r in got)


def test_frequent_words_bring_no_texts_together(spark, monkeypatch):
    """Groups hold copies, not all texts that share some run of frequent words."""
    rng, found = random.Random(5), {}
    frequent = [f"f{i}" for i in range(20)]

    def text(i):
        words = rng.choices(frequent, k=20)
        return " ".join([*words[:9], f"own{i}", f"rare{i}", *words[9:]])

    rows = [(i, text(i)) for i in range(600)]
    rows += [(1000 + i, f"{rows[i][1]} more{i}") for i in range(7)]
    stored = jaccard_join.stored

    def kept(df, label, **options):
        found[label] = stored(df, label, **options)
        return found[label]

    monkeypatch.setattr(jaccard_join, "stored", kept)
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, (90, 100)).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: i % 1000 for i, _ in rows}
    assert found["members"].count() == 14


def test_rows_are_kept_by_id_and_text(spark):
    """Null and repeated ids: one row of each component stays, and only contaminated rows go."""
    passage = " ".join(f"word{i}" for i in range(30))
    other = " ".join(f"else{i}" for i in range(30))
    near = passage + " end"
    rows = [
        (None, passage, "a"), (None, passage, "b"), (None, near, "c"), (None, other, "d"), (None, None, "e"), (None, "", "f"),
        (7, passage, "g"), (7, other, "h"), (7, "", "i"), (7, "", "j"), (8, other, "k"), (9, "alone", "l"), (9, "alone", "m"), (9, "apart", "n"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _mark string")
    kept = sorted((repr(r.doc_id), r.text or "") for r in jaccard_join.keep_one(docs).collect())
    # Components: passage and near (smallest id 7), other (7), alone (9), apart (9); rows without words all stay.
    wanted = [(7, passage), (7, other), (9, "alone"), (9, "apart"), (None, ""), (None, ""), (7, ""), (7, "")]
    assert kept == sorted((repr(i), t) for i, t in wanted)
    items = spark.createDataFrame([("x", passage)], "item_id string, text string")
    clean = {r._mark for r in decontaminate.drop_contaminated(docs, items).collect()}
    assert clean == set("defhijklmn")
    for size in (1, 2):  # the smallest id is null where there is no other
        none = docs.where("doc_id IS NULL AND text IS NOT NULL AND text <> ''").limit(size)
        assert jaccard_join.keep_one(none).count() == 1


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (4, 5), (9, 8), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 7: 7}


def test_several_query_blocks_and_proximity(spark, docs, monkeypatch):
    items = table(spark, DATA, "benchmark")
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256"]
    want = sorted(decontaminate.contamination(docs, items).select(columns).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 200)
    monkeypatch.setattr(decontaminate, "SEGMENT_WORDS", 5000)
    assert sorted(decontaminate.contamination(docs, items).select(columns).collect()) == want
    texts = spark.createDataFrame([(1, "one two three x four five"), (2, "one two three four five"), (3, "five four")], "doc_id long, text string")
    item = spark.createDataFrame([("i", "one two three four five")], "item_id string, text string")
    exact = {r.doc_id: len(r.spans) for r in decontaminate.find_matches(texts, item, 5).collect()}
    near = {r.doc_id: len(r.spans) for r in decontaminate.find_matches(texts, item, 5, slop=1).collect()}
    assert exact == {1: 0, 2: 1, 3: 0} and near == {1: 1, 2: 1, 3: 0}


def test_every_repeated_run_of_fifty_words_is_in_a_passage(docs, raw):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW)) for i, t in raw.items()}
    found = {}
    for r in fuzzy_passages.fuzzy_passages(docs).collect():
        found.setdefault(r.doc_id, []).append((r.start, r.end))
        if r.identity == 1.0:
            assert words[r.doc_id][r.start : r.end] == words[r.ref_doc_id][r.ref_start : r.ref_end]
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - 49):
            run = tuple(words[i][p : p + 50])
            if first.setdefault(run, i) != i:
                assert any(a <= p + 2 and p + 48 <= b for a, b in found[i]), (i, p)


def test_stretches_meet_where_the_texts_around_may_hold_a_passage():
    """Three hundred texts with one common line: only pairs whose surroundings allow a passage are matched, and all of
    those that have one, across blocks too."""
    rng = random.Random(12)
    line = [f"c{i}" for i in range(13)]
    sides = [[f"s{n}x{i}" for i in range(60)] for n in range(40)]
    texts = []
    for doc in range(300):
        around = [f"f{rng.getrandbits(40)}" for _ in range(60)]
        if doc % 3 == 0:  # a changed copy of one of the surroundings
            around = [w if rng.random() < rng.choice([0.6, 0.75, 0.9]) else f"f{rng.getrandbits(40)}" for w in rng.choice(sides)]
        texts.append([*around[:30], *line, *around[30:]])
    rows = []
    for doc, words in enumerate(texts):
        start = len(" ".join(words[:30])) + 1
        row = {"seed": 5, "doc_id": doc, "x0": 30, "b0": start, "x1": 39, "from0": 0, "more0": 0, "mine": " ".join(words).encode()}
        block = rng.randrange(2)
        rows += [row | {"block": block, "low": min(block, other), "high": max(block, other)} for other in range(2)]
    rows.sort(key=lambda r: (r["low"], r["high"], r["doc_id"]))
    got = {}
    for batch in fuzzy_passages._meet(iter(pa.Table.from_pylist(rows).to_batches(101)), 40, 0.8, 7):
        for found in fuzzy_passages._unpack_matches(iter([batch])):
            for r in found.to_pylist():
                got.setdefault((r["doc_id"], r["ref"]), []).append((r["place"], r["ref_place"]))
    pairs = [(a, b) for a in range(300) for b in range(a) if a % 3 == 0 == b % 3]
    want = {(a, b) for a, b in pairs if fuzzy_passages.align(texts[a], texts[b], 40, 0.8)}
    assert len(want) > 20 and want <= set(got)
    assert len(got) < 300 and all(a % 3 == 0 == b % 3 for a, b in got)
    for (a, b), found in got.items():
        ends = [[(w << 32) | len(" ".join([*texts[d][:w], ""])) for w in (30, 39)] for d in (a, b)]
        assert sorted(found) == sorted(zip(*ends, strict=True))


def covered(rows, doc, start, end):
    """Largest share of the words ``start`` to ``end`` of a document that one passage covers."""
    spans = [(r.start, r.end) for r in rows if r.doc_id == doc]
    return max((max(0, min(b, end) - max(a, start)) / (end - start) for a, b in spans), default=0)


def test_passages_whose_parts_stand_in_other_documents(spark):
    rng = random.Random(7)

    def filler(n):
        return [f"f{rng.getrandbits(40)}" for _ in range(n)]

    texts, want = {}, []
    for case in range(40):
        passage = [f"p{case}x{i}" for i in range(50)]
        cut = rng.randint(15, 35)
        parts = [passage[:cut], passage[cut:], passage[: cut + 3], passage[cut - 3 :]]
        # Parts before and between the two whole ones: more of them than places that a seed is matched with.
        for n, words in enumerate([*parts, passage, *(parts * 6), passage]):
            texts[case * 100 + n] = " ".join(filler(20) + words + filler(20))
        want.append(case * 100 + n)
    rows = fuzzy_passages.fuzzy_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert [i for i in want if covered(rows, i, 20, 70) < 1] == []


def test_passages_with_planted_edits(spark):
    rng = random.Random(8)

    def filler(n):
        return [f"f{rng.getrandbits(40)}" for _ in range(n)]

    texts, want = {}, {}
    for case in range(400):
        n, every = rng.choice([(40, 5), (40, 0), (45, 0), (60, 5), (60, 7), (60, 8), (60, 10), (100, 5), (100, 7)])
        passage, edited = filler(n), []
        for i, word in enumerate(passage):
            if every and i % every == every // 2:
                edit = rng.choice("sssid")
                edited += {"s": filler(1), "i": [*filler(1), word], "d": []}[edit]
            else:
                edited.append(word)
        texts[2 * case] = " ".join(filler(30) + passage + filler(30))
        texts[2 * case + 1] = " ".join(filler(30) + edited + filler(30))
        # What counts is the best span by the definition: both ends equal, enough words, enough of them equal.
        steps = fuzzy_passages.align(edited, passage, 40, 0.8)
        if steps:
            want[2 * case + 1] = (30 + steps[0][0], 30 + steps[0][1])
    rows = fuzzy_passages.fuzzy_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert len(want) > 250
    assert [i for i, (a, b) in want.items() if covered(rows, i, a, b) < 0.9] == []
    assert all(r.ref_doc_id == r.doc_id - 1 and r.identity >= 0.8 - 1e-9 and r.end - r.start >= 40 for r in rows)


def test_passages_of_long_words_keep_their_ends(spark):
    texts, want = {}, []
    for case, size in enumerate((1, 30, 60, 200, 2000)):
        for tail in (0, 5, 100):
            n = 10 * len(want)
            passage = [f"p{n}x{i}".ljust(size, "日") for i in range(40)]
            edited = [w + "z" if i % 4 == 3 and not 11 < i < 28 else w for i, w in enumerate(passage[:39])] + passage[39:]
            edited[39] = passage[39]
            for doc, words in ((n, passage), (n + 1, edited)):
                around = [f"f{doc}x{i}".ljust(size, "本") for i in range(100 + tail)]
                texts[doc] = "  ".join(around[:100] + words + around[100:])
            want.append(n + 1)
    rows = fuzzy_passages.fuzzy_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.start, r.end, r.ref_start, r.ref_end) for r in rows) == [(i, 100, 140, 100, 140) for i in want]


def test_changed_passages_of_common_seeds(spark):
    """Each run of six words of the passage stands in more documents than places that a seed is matched with, before
    and after the only document that holds the passage itself."""
    rng = random.Random(11)

    def filler(n):
        return [f"f{rng.getrandbits(40)}" for _ in range(n)]

    texts, want = {}, []
    for case in range(4):
        runs = [[f"p{case}x{r}x{i}" for i in range(6)] for r in range(8)]
        passage = [word for run in runs for word in [*run, *filler(1)]]
        edited = [word for run in runs for word in [*run, *filler(1)]]
        n = 1000 * case
        for held in ([[*r, *filler(30)] for _ in range(12) for r in runs], [passage], [[*r, *filler(30)] for _ in range(12) for r in runs], [edited]):
            for words in held:
                texts[n] = " ".join(filler(20) + words + filler(20))
                n += 1
        want.append((n - 1, 1000 * case + 96))
    rows = fuzzy_passages.fuzzy_passages(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert [(r.doc_id, r.ref_doc_id) for r in sorted(rows)] == want
    assert all(covered(rows, doc, 20, 75) == 1 for doc, _ in want)


def test_packed_rows_are_the_same_rows():
    rng = np.random.default_rng(1)
    ends = [-(1 << 63), (1 << 63) - 1, 0, -1]
    for n in (1, 2, 300):
        table = np.stack([np.sort(rng.integers(0, 1 << 48, n)), rng.choice(ends, n), rng.integers(-9, 9, n), np.zeros(n, np.int64)])
        assert (unpack(pack(table), 4) == table).all()


def test_seeds_are_dealt_in_few_bytes_and_only_shared_ones_are_matched(spark):
    """A seed was a row of three 64-bit numbers in the shuffle, whether another document holds it or not."""
    rng = random.Random(12)
    line = [f"line{i}" for i in range(9)]
    texts = [(i, " ".join([f"w{rng.randint(0, 20000)}" for _ in range(300)] + (line if i % 3 else [])) + "  ") for i in range(200)]
    texts += [(300, texts[0][1] + "end"), (300, texts[5][1]), (None, None)]
    batch = spark.createDataFrame(texts, "doc_id long, text string").fillna({"doc_id": -5}).toArrow().to_batches()
    packs = sorted((b for p in fuzzy_passages._seeds(iter(batch), 4, 16) for b in p.to_pylist()), key=lambda r: r["part"])
    brute, n = {}, 0
    for doc, text in texts:
        words = [(m.start(), m.group()) for m in re.finditer(r"[^ ]+", text or "")]
        for i in range(len(words) - 3):
            brute.setdefault(tuple(w for _, w in words[i : i + 4]), []).append((doc, (i << 32) | words[i][0]))
            n += 1
    assert sum(len(r["packed"]) for r in packs) < 10 * n
    # The parts of a seed may come in several batches.
    batches = (pa.RecordBatch.from_pylist(packs[i : i + 5]) for i in range(0, len(packs), 5))
    got = {}
    for found in fuzzy_passages._shared(batches):
        for r in found.to_pylist():
            got.setdefault(r["seed"], []).append((r["doc_id"], r["place"]))
    want = [sorted(v) for v in brute.values() if len({doc for doc, _ in v}) > 1]
    assert len(want) > 300 and sorted(map(sorted, got.values())) == sorted(want)


def test_partners_of_every_place_across_chunks(monkeypatch):
    rng = random.Random(13)
    for chunk in (1, 7, 1 << 17):
        monkeypatch.setattr(fuzzy_passages, "CHUNK", chunk)
        rows = sorted({(seed, rng.randint(0, 9 if seed else 40), (rng.randint(0, 30) << 32) | rng.randint(0, 500)) for seed in range(12) for _ in range(rng.randint(1, 60))})
        table = pa.table({c: [r[i] for r in rows] for i, c in enumerate(("seed", "doc_id", "place"))})
        packed = list(fuzzy_passages._partners(iter(table.to_batches(13)), 3, 1, True, 5))
        both = [[b for b in packed if b.column("weight")[0].as_py() == w] for w in (0, 1)]
        places = [tuple(r.values()) for b in fuzzy_passages._unpack_places(iter(both[0])) for r in b.to_pylist()]
        matches = [tuple(r.values()) for b in fuzzy_passages._unpack_matches(iter(both[1])) for r in b.to_pylist()]
        held, want = {}, []
        for seed, doc, place in rows:
            held.setdefault(seed, []).append((doc, place))
        for group in held.values():
            for doc, place in group:
                before = [r for r in group if r[0] < doc]
                want += [(doc, ref, place, other, 1) for ref, other in before[-3:] + (before[:1] if len(before) > 3 else [])]
        assert sorted(matches) == sorted(want)
        assert sorted(places) == sorted(r for r in rows if len({doc for doc, _ in held[r[0]]}) > 1)


def test_edit_path_is_shortest():
    rng = random.Random(9)
    for _ in range(300):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 25))] for _ in range(2))
        x = y = cost = 0
        for da, db in fuzzy_passages.word_path(a, b):
            cost += not (da and db and a[x] == b[y])
            x, y = x + da, y + db
        assert (x, y, cost) == (len(a), len(b), fuzzy_passages.edit_distance(a, b))


def test_paths_by_diagonals_tables_and_halves_are_shortest(monkeypatch):
    rng = random.Random(10)
    for _ in range(1500):
        monkeypatch.setattr(fuzzy_passages, "NEAR_EDITS", rng.choice([0, 2, 32]))
        monkeypatch.setattr(fuzzy_passages, "TABLE", rng.choice([1, 50, 1 << 24]))
        a = [rng.randint(0, 3) for _ in range(rng.randint(0, 25))]
        b = [w for w in a if rng.random() > 0.1] + [9] * rng.randint(0, 2)
        if rng.random() < 0.5:
            b = [rng.randint(0, 3) for _ in range(rng.randint(0, 25))]
        x = y = cost = 0
        for da, db in fuzzy_passages.word_path(a, b):
            cost += not (da and db and a[x] == b[y])
            x, y = x + da, y + db
        assert (x, y, cost) == (len(a), len(b), fuzzy_passages.edit_distance(a, b))


def test_rows_left_out_before_alignment_hold_no_passage():
    rng, held, tried = random.Random(3), 0, 0
    for _ in range(150):
        sides = ([], [])
        for _ in range(rng.randint(1, 12)):
            words, edits = [rng.randint(0, 300) for _ in range(rng.randint(0, 90))], rng.choice([0, 0.1, 0.18, 0.25, 0.4, 0.9])
            other = []
            for word in words:
                new = rng.randint(0, 300)
                other += rng.choice([[], [new], [word, new]]) if rng.random() < edits else [word]
            sides[0].append(words)
            sides[1].append(other)
        flat = [x for side in sides for x in (np.array(sum(side, []), np.int64), np.repeat(np.arange(len(side)), [len(w) for w in side]))]
        kept = set(fuzzy_passages._may_align(*flat, 40, 0.8)) & set(fuzzy_passages._may_align(*flat[2:], *flat[:2], 32, 0.8))
        want = {r for r, (a, b) in enumerate(zip(*sides, strict=True)) if fuzzy_passages.align(a, b, 40, 0.8)}
        assert want <= kept
        held, tried = held + len(want), tried + len(kept)
    assert 0 < held <= tried < 1.3 * held


def test_edit_distance_agrees_with_the_table_method():
    rng = random.Random(6)
    for _ in range(100):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 25))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        assert fuzzy_passages.edit_distance(a, b) == row[-1]


def test_language_of_held_out_documents(docs):
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in language.identify(docs).collect() if r.held_out]
    assert held and np.mean([truth[r.doc_id] == r.lang_pred for r in held]) >= 0.95


def test_quality_of_held_out_documents(spark):
    data = "/root/testdata/sf0.01"
    labels = table(spark, data, "labels")
    truth = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.classify(table(spark, data, "documents"), labels).collect()
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(0 <= r.score <= 1 for r in rows)
    assert np.mean([truth[r.doc_id] == r.predicted for r in held]) >= 0.95


def plain_features(texts):
    """Word vectors and pooled features with dictionaries and loops, from the words that ``word_rows`` names."""
    from aerolith.llm.arrays import text_bytes

    dimension, sign = quality.index_vectors()
    lists = []
    for text in texts:
        rows, shape, _ = quality.word_rows(*text_bytes(pa.array([text])))
        lists.append((rows.tolist(), shape.tolist()))
    context = np.zeros((quality.WORDS, quality.DIMENSIONS))

    def add(row, other):
        for k in range(quality.NONZERO):
            context[row, dimension[other, k]] += -1 if sign[other, k] else 1

    for rows, shape in lists:
        for i, row in enumerate(rows):
            for j in range(max(0, i - quality.REACH), min(len(rows), i + quality.REACH + 1)):
                if j != i:
                    add(row, rows[j])
            add(row, shape[i])
            add(shape[i], row)
    vectors = np.zeros_like(context)
    for n, line in enumerate(context):
        line = np.sign(line) * np.sqrt(np.abs(line))
        vectors[n] = line / max(math.sqrt((line**2).sum()), 1e-9)
    used = np.abs(vectors).sum(axis=1) > 0
    vectors[used] -= vectors[used].mean(axis=0)
    features = np.zeros((len(texts), 2 * quality.DIMENSIONS))
    for n, (rows, shape) in enumerate(lists):
        for row, mark in zip(rows, shape, strict=True):
            features[n, : quality.DIMENSIONS] += vectors[row] / len(rows)
            features[n, quality.DIMENSIONS :] += vectors[mark] / len(rows)
    return vectors, features


def test_context_counts_take_little_memory():
    rng = random.Random(12)
    text = " ".join(f"w{rng.randrange(3000)}" for _ in range(900))
    batch = pa.RecordBatch.from_arrays([pa.array([text] * 1000)], ["text"])
    tracemalloc.start()
    list(quality._context(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 120e6


def test_quality_by_plain_loops(spark, docs):
    """Vectors, pooling and the network's output, each against its definition, on whole documents."""
    labels = table(spark, DATA, "labels")
    sample = docs.where(F.length(F.coalesce("text", F.lit(""))) < 3000)
    rows = [(r.doc_id, r.text or "") for r in sample.collect()]
    vectors, features = plain_features([t for _, t in rows])
    model = quality.train(sample, labels)
    assert np.abs(model.vectors - vectors).max() < 1e-4
    got = quality.pooled(model.vectors, pa.array([t for _, t in rows]))
    assert np.abs(got - features).max() < 1e-4
    scores = {r.doc_id: r.score for r in quality.classify(sample, labels).collect()}
    w1, b1, w2, b2 = model.layers
    for (i, _), x in zip(rows, features, strict=True):
        hidden = [math.tanh(sum(a * w for a, w in zip((x - model.center) / model.scale, column, strict=True)) + b) for column, b in zip(w1.T, b1, strict=True)]
        logit = sum(h * w for h, w in zip(hidden, w2, strict=True)) + b2[0]
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-logit / model.temperature)), abs=1e-3)
    # The labelled rows that are not held out, and no others, are fitted: the network from them alone is the same.
    truth = {r.doc_id: r.quality for r in labels.collect() if r.quality is not None}
    learned = sorted((i, x) for (i, _), x in zip(rows, got, strict=True) if i in truth and zlib.crc32(str(i).encode()) % 5)
    again = quality.fit(model.vectors, np.array([x for _, x in learned]), np.array([truth[i] for i, _ in learned]))
    assert all(np.allclose(a, b) for a, b in zip(again.layers, model.layers, strict=True)) and again.temperature == model.temperature
    kept = {r.doc_id for r in quality.keep_good(sample, labels).collect()}
    assert kept == {i for i, s in scores.items() if s >= quality.THRESHOLD}


def test_repeated_labelled_ids_stay_within_the_bound(spark):
    docs = spark.createDataFrame([(i % 3, f"word {i} " * 4) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1)], "doc_id long, quality int")
    assert quality.classify(docs, labels).count() == 60
    assert quality.train(docs, labels, 5) is not None


def test_roles_of_held_out_turns_and_blocks(spark, monkeypatch):
    conversations = table(spark, DATA, "conversations")
    rows = transcripts.chat_turns(conversations).collect()
    assert np.mean([bool(r.agrees) for r in rows if r.held_out]) >= 0.9
    monkeypatch.setattr(transcripts, "TURNS", 2)
    again = transcripts.chat_turns(conversations).collect()
    assert sorted((r.conv_id, r.turn, r.part, r.role) for r in rows) == sorted((r.conv_id, r.turn, r.part, r.role) for r in again)


CONV = "text string, conv_id long, turn long, role string, block int, part int"


def chat(spark, *rows):
    """Rows of (conversation, turn, role, text) after the driver's conversations, the columns in another order."""
    known = table(spark, DATA, "conversations").select("text", "conv_id", "turn", "role").withColumns({"block": F.lit(1), "part": F.lit(2)})
    new = spark.createDataFrame([(t, c, n, r, None, 1) for c, n, r, t in rows], CONV)
    return known.unionByName(new)


def test_markers_name_the_roles(spark):
    text = "System: be kind\nUser: hi\nthere?\n[Assistant] yes\n<|user|> bye\n**AI:** so\nlong "
    got = transcripts.canonical_turns(chat(spark, (-1, 0, None, text))).where("conv_id = -1").orderBy("part").collect()
    want = [("system", "be kind"), ("user", "hi\nthere?"), ("assistant", "yes"), ("user", "bye"), ("assistant", "so\nlong ")]
    assert [(r.role, r.content) for r in got] == want


@pytest.mark.parametrize("text", ["a", "A - good plan", "Question", "Tool", "Model\n", "me - we\n\nAgent", " sys ", "tool: x\n[function]", "Answer is: no"])
def test_words_that_mark_no_speaker_are_kept(spark, text):
    """Bare words, and markers of a role that nobody has, are text."""
    got = transcripts.canonical_turns(chat(spark, (-1, 0, "user", text))).where("conv_id = -1").orderBy("part").collect()
    assert "\n".join(r.content for r in got) == text


def test_markers_that_the_rows_speak_against_are_kept(spark):
    """Where rows of users open with a listed word of another role, the counts decide."""
    rows = [(-i, 0, "user", f"A: point {i}") for i in range(1, 60)]
    got = transcripts.canonical_turns(chat(spark, *rows)).where("conv_id < 0").collect()
    assert {(r.role, r.content) for r in got} == {("user", f"point {i}") for i in range(1, 60)}
    # One alone, where an assistant may speak, is what the list says.
    alone = transcripts.canonical_turns(chat(spark, (-1, 0, None, "Which one?"), (-1, 1, None, "A: point"))).where("conv_id = -1 AND turn = 1")
    assert [(r.role, r.content) for r in alone.collect()] == [("assistant", "point")]


def test_viterbi_finds_the_best_of_all_paths():
    rng = np.random.default_rng(3)
    roles = ["a", "assistant", "user"]
    texts = ["hello?\nUser: x", "one\ntwo", "Assistant: y"]
    for _ in range(20):
        emission = [{v: np.log(rng.uniform(0.1, 1, 3)) for v in range(9)} for _ in range(4)]
        model = transcripts.fitted(roles, rng.uniform(0.1, 1, 3), rng.uniform(0.1, 1, (3, 3)), emission, [np.log([0.1] * 3)] * 4, transcripts.marker_shares(roles, {}))
        steps = list(model.steps(texts))
        best = {}
        for path in itertools.product(range(3), repeat=len(steps)):
            score, state = 0.0, 3
            for nth, (move, emitted) in zip(path, steps, strict=True):
                score, state = score + move[state, nth] + emitted[nth], nth
            best[path] = score
        top = max(best.values())
        (entry,), (last,) = transcripts.chained([model.matrix(texts)])
        found = tuple(model.path(texts, entry, last))
        assert entry == 3 and best[found] == pytest.approx(top)
        entries, lasts = transcripts.chained([model.matrix([t]) for t in texts])
        blocks = [s for t, e, f in zip(texts, entries, lasts, strict=True) for s in model.path([t], e, f)]
        assert best[tuple(blocks)] == pytest.approx(top)


def test_any_number_of_roles(spark):
    rows = [(i, i % 3, f"role{i % 25:02d}", f"text {i}\n" * (i % 4 + 1)) for i in range(400)]
    got = transcripts.canonical_turns(chat(spark, *rows)).select("role").distinct().count()
    assert transcripts.chat_turns(chat(spark, *rows)).where("conv_id < 400").count() >= 400 and got >= 3


def test_odd_conversations(spark):
    """Null turns, ids, roles and texts, repeated rows and turns, blank lines: every character stays, every row has a turn."""
    rows = [
        (-1, None, "user", "late"), (-1, 2**63 - 1, "user", "last"), (-1, 0, "user", ""), (-1, 0, "user", ""), (-1, 0, None, None),
        (None, None, None, "lone\n\n  x "), (None, 1, "assistant", "b"), (-2, -5, "user", "\n\n"), (-3, 1, "user", "same"), (-3, 1, "user", "same"),
    ]
    df = spark.createDataFrame([(t, c, n, r, None, 1) for c, n, r, t in rows], CONV)
    got = transcripts.canonical_turns(df).collect()
    texts = {}
    for r in sorted(got, key=lambda r: r.part):
        texts.setdefault((r.conv_id, r.turn), []).append((r.part, r.content, r.rendered, r.role))
    for (conv, turn), parts in texts.items():
        want = [t or "" for c, n, _, t in rows if c == conv and (n if n != 2**63 - 1 else None) == turn]
        assert sorted(x for _, x, _, _ in parts) == sorted(want)
        assert all(f"<|{role}|>\n{x}\n<|end|>\n" == shown for _, x, shown, role in parts)
    assert sum(map(len, texts.values())) == len(rows)
    assert {r.role for r in transcripts.chat_turns(df.withColumn("role", F.lit(None).cast("string"))).collect()} == {"user"}


def test_any_number_of_languages(spark, docs):
    whole = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in language.identify(docs).collect()}
    blocks = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in language.identify(docs, most=2).collect()}
    assert {i: v[:2] for i, v in whole.items()} == {i: v[:2] for i, v in blocks.items()}
    assert all(abs(whole[i][2] - blocks[i][2]) < 1e-6 for i in whole)
    many = spark.createDataFrame([(i, f"w{i % 400}x " * 5, f"l{i % 400:03d}") for i in range(1200)], "doc_id long, text string, lang string")
    assert language.identify(many).where("lang_pred IS NULL").count() == 0 and language.identify(many).count() == 1200


def test_language_scores_by_plain_counting(docs):
    """Naive Bayes with dictionaries over the same grams and cells."""
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect() if len(r.text or "") < 4000]
    sample = docs.where(F.length(F.coalesce("text", F.lit(""))) < 4000)

    def cells(text):
        line = "".join(c if unicodedata.category(c)[0] == "L" else " " for c in (text or "").lower())
        grams = (line[k : k + n] for n in (1, 2, 3) for k in range(len(line) - n + 1))
        for gram in grams:
            if gram.strip():
                value = 0
                for c in gram:
                    value = value << 21 | ord(c)
                yield ((value * 8 + len(gram)) * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - language.BITS)

    counts, priors = {}, Counter()
    for i, text, lang in rows:
        if lang is not None and text is not None and zlib.crc32(str(i).encode()) % 5:
            counts.setdefault(lang, Counter()).update(cells(text))
            priors[lang] += 1
    totals = {x: sum(c.values()) + 0.5 * language.CELLS for x, c in counts.items()}
    got = {r.doc_id: (r.lang_pred, r.score) for r in language.identify(sample).collect()}
    for i, text, _ in rows[:60]:
        found = list(cells(text))
        scores = {x: math.log(priors[x] / sum(priors.values())) + sum(math.log((counts[x][c] + 0.5) / totals[x]) for c in found) for x in counts}
        best = max(scores.values())
        share = 1 / sum(math.exp(s - best) for s in scores.values())
        want = min(x for x in scores if scores[x] == best) if found else "und"
        assert got[i][0] == want and got[i][1] == pytest.approx(share if found else 0, abs=1e-3)


def test_odd_rows(odd, spark):
    items = spark.createDataFrame([(1, None), (None, "word0 word1 word2 word3 word4 word5 word6 word7 word8 word9"), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(4, 1, 0), (7, 0, 0), (7, 0, None), (None, 1, 1), (8, None, 0)], "doc_id long, quality int, toxic int")
    n = odd.count()
    groups = exact_dedup.exact_groups(odd).collect()
    assert len(groups) == n and sum(r.kept for r in groups) == len({r.text_sha256 for r in groups})
    assert exact_dedup.keep_first(odd).columns == odd.columns
    assert exact_dedup.keep_first(odd).count() == sum(r.kept for r in groups)
    assert token_store.store_digest(odd).count() == n
    assert packing.packing_digest(odd).where("piece = 0").count() == n
    near = {(r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(odd, 3, (90, 100)).collect()}
    assert {(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (12, 4), (None, 4), (None, None)} <= near
    assert jaccard_join.keep_one(odd).columns == odd.columns
    hits = {r.doc_id: r.contaminated for r in decontaminate.contamination(odd, items).collect()}
    assert hits[4] and hits[6] and hits[11] and not hits[1] and not hits[9]
    assert decontaminate.drop_contaminated(odd, items).columns == odd.columns
    assert suffix_dedup.suffix_digest(odd).count() == n
    assert fuzzy_passages.fuzzy_passages(odd).where("doc_id = 11").count() == 1
    spoken = {r.doc_id: r.lang_pred for r in language.identify(odd).collect()}
    assert spoken[1] == spoken[2] == spoken[3] == "und"
    assert quality.classify(odd, labels).count() == n
    assert quality.keep_good(odd, labels).columns == odd.columns


def test_empty_tables(none, spark):
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for result in (
        exact_dedup.exact_groups(none), exact_dedup.keep_first(none), token_store.store_digest(none), packing.packing_digest(none),
        jaccard_join.jaccard_components(none), jaccard_join.keep_one(none), decontaminate.contamination(none, items),
        suffix_dedup.suffix_digest(none), fuzzy_passages.fuzzy_passages(none), language.identify(none), quality.classify(none, labels),
        quality.keep_good(none, labels), transcripts.chat_turns(turns),
    ):
        assert result.count() == 0


def test_pipeline_of_odd_and_empty_tables(spark, odd, none, tmp_path):
    """``run`` over null, empty, repeated and very long texts, and over tables without rows."""
    items = spark.createDataFrame([("1", "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id string, text string")
    labels = spark.createDataFrame([(4, 1, 0), (7, 1, 0)], "doc_id long, quality int, toxic int")
    long = spark.createDataFrame([(50, "many words of one text " * 200_000, "en", "s", 1, 1, 1, 1), (51, "alpha beta gamma delta epsilon zeta eta theta iota kappa", None, None, 1, 1, 1, 1)], SCHEMA)
    for name, docs in (("full", odd.unionByName(long)), ("empty", none)):
        folder = str(tmp_path / name)
        docs.write.parquet(f"{folder}/documents.parquet")
        (items if name == "full" else items.limit(0)).write.parquet(f"{folder}/benchmark.parquet")
        (labels if name == "full" else labels.limit(0)).write.parquet(f"{folder}/labels.parquet")
        got = corpus_pipeline.run(spark, folder).collect()
        if name == "empty":
            assert got == []
            continue
        # All labels are 1, so all rows are good; of equal texts without spaces the longest original stays, here 6 and
        # 11 near it; the text of one word and the long one are alone; the benchmark's passage goes.
        ids = {r.doc_id for r in got}
        assert 50 in ids and 51 not in ids and {7, 8, 9, 10} <= ids
        assert sum(r.length for r in got if r.doc_id == 50) == len(_encoded({50: "many words of one text " * 200_000}, 0)[50])
        passages = {4, 5, 6, 11, 12}
        assert len(ids & passages) == 1


def test_pipeline_stages(spark, raw):
    kept = table(spark, DATA, "documents")
    columns = kept.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, kept, DATA).cache()
        assert after.columns == columns and after.count() <= kept.count(), name
        kept = after
    ids = {r.doc_id for r in kept.collect()}
    final = {r.doc_id for r in corpus_pipeline.run(spark, DATA).collect()}
    assert final == ids and len(ids) > 0.5 * len(raw)


def test_pipeline_stages_keep_the_rows_of_brute_force(spark, docs):
    """The ids that three stages keep, each by its rule on all pairs or places of the stage's own input."""

    def texts_of(df):
        return {r.doc_id: r.text or "" for r in df.collect()}

    def kept_by(stage, df):
        return sorted(r.doc_id for r in dict(corpus_pipeline.STAGES)[stage](spark, df, DATA).collect())

    inputs = texts_of(docs)
    assert len(inputs) == docs.count()
    best = {}
    for i, text in inputs.items():
        key = re.sub(r"[\x20\x09-\x0D]+", "", text)
        best[key] = min(best.get(key, (1, 0)), (-len(text), i))
    assert kept_by("exact_dedup", docs) == sorted(i for _, i in best.values())

    sets = {}
    for i, text in inputs.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOW))
        sets[i] = {tuple(words[p : p + 5]) for p in range(max(len(words) - 4, 1))} if words else set()
    root = {i: i for i in sets}
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    assert kept_by("near_dedup", docs) == [i for i in ids if root[i] == i]

    def plain(text):
        return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOW).encode())

    windows = set()
    for r in table(spark, DATA, "benchmark").collect():
        words = plain(r.text or "")
        windows |= {tuple(words[p : p + 10]) for p in range(max(len(words) - 9, 1))} if words else set()
    sizes = {len(w) for w in windows}
    clean = []
    for i, text in inputs.items():
        words = plain(text)
        if not any(tuple(words[p : p + n]) in windows for n in sizes for p in range(len(words) - n + 1)):
            clean.append(i)
    assert kept_by("decontamination", docs) == sorted(clean)
    assert len(best) < len(inputs) and len(clean) < len(inputs) and any(root[i] != i for i in ids)
