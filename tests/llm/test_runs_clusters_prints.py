"""Periodic runs, centroid clustering and SimHash against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest

from aerolith.llm import centroids, periodic_runs, simhash
from aerolith.llm.tables import table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver data not present")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = "text string, doc_id long, vec_id long, print long, _root long, start int"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, DATA, "documents").cache()


@pytest.fixture(scope="module")
def raw(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty texts, repeated rows and ids, clashing columns, a text of two million words."""
    line = " ".join(f"w{i}" for i in range(9))
    texts = [None, "", " \n\t", "a", "A a", line, line, line.upper(), " ".join([line] * 7), "日本 語" * 40, "x " * 2_000_000]
    rows = [(t, i, None, i, 1, 2) for i, t in enumerate(texts)] + [(line, 5, 1, 1, 1, 1), (line + " z", None, 1, 1, 1, 1), (None, None, 1, 1, 1, 1)]
    return spark.createDataFrame(rows, ODD)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def runs_of(x):
    """Every maximal stretch with at least two periods, by comparing it with itself at every lag."""
    found = {}
    for p in range(1, len(x) // 2 + 1):
        j = 0
        while j < len(x) - p:
            k = j
            while k < len(x) - p and x[k] == x[k + p]:
                k += 1
            if k - j >= p:
                found.setdefault((j, k + p), p)
            j = k + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def random_sequence(rng):
    n, letters = rng.randint(1, 300), rng.choice([1, 2, 2, 3, 5, 50])
    kind = rng.randrange(6)
    unit = [rng.randrange(letters) for _ in range(rng.randint(1, 60))]
    if kind == 0:
        return [rng.randrange(letters) for _ in range(n)]
    if kind == 1:
        x = (unit * n)[:n]
        for _ in range(rng.randint(0, 3)):
            x[rng.randrange(n)] = letters
        return x
    if kind == 2:
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 3:
        return [bin(i).count("1") & 1 for i in range(n)]
    if kind == 4:  # stretches of one short period that meet out of step
        x = []
        while len(x) < n:
            x += (unit[:5] * 30)[: rng.randint(1, 70)]
        return x[:n]
    u = (unit[:3] * 30)[: rng.randint(16, 80)] + unit[3 : rng.randint(3, 6)]
    return (u * rng.randint(2, 5))[rng.randrange(len(u)) :]


def test_runs_of_any_sequence():
    rng = random.Random(1)
    for _ in range(300):
        parts = [random_sequence(rng) for _ in range(4)]
        line, want = [], set()
        for n, x in enumerate(parts):
            want |= {(s + len(line), s + k + len(line), p) for s, k, p in runs_of(x)}
            line += [*x, 1000 + n]
        runs = periodic_runs.Runs(np.array(line), max(map(len, parts)))
        assert set(zip(runs.start.tolist(), runs.end.tolist(), runs.period.tolist(), strict=True)) == want


def replaced(doc, words):
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if doc is None or h % 10 or not n:
        return words
    a = h // 10 % n
    p = 1 + (n - a) // (3 + h // 10 % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def digest(doc, text):
    words = replaced(doc, words_of(text))
    runs = [r for r in runs_of(words) if r[1] >= 12]
    gone = {i for s, k, p in runs for i in range(s + p, s + k)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    best = (*top, 1000 * top[1] // top[2]) if top else (None,) * 4
    printed = "".join(f"{s},{k},{p}\n" for s, k, p in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc, len(runs), *best, *(hashlib.sha256(t.encode()).hexdigest() for t in (printed, kept)))


def test_runs_of_documents(docs, raw):
    short = [(i, t) for i, t in raw if len(t or "") < 30_000]
    assert len(short) > 0.9 * len(raw)
    got = {tuple(r) for r in periodic_runs.collapsed_digest(docs).collect()}
    assert {digest(i, t) for i, t in short} <= got and len(got) == len(raw)
    assert any(r[1] for r in got) and any(not r[1] for r in got)


def test_runs_of_odd_rows(odd):
    rows = odd.collect()
    got = sorted(repr(tuple(r)) for r in periodic_runs.collapsed_digest(odd).collect() if r.doc_id != 10)
    assert got == sorted(repr(digest(r.doc_id, r.text)) for r in rows if r.doc_id != 10)
    found = {r.doc_id: (r.start, r.length, r.period) for r in periodic_runs.periodic_runs(odd).collect()}
    assert found[10] == ([0], [2_000_000], [1]) and found[8] == ([0], [63], [9]) and found[0] == ([], [], [])


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(v) for v in rng.normal(0, 1 + i % 7, 5)], 0) for i in rng.permutation(300)]
    bad = [(1, None, 0), (2, [1.0] * 4, 0), (3, [1.0] * 6, 0), (4, [1.0, None, 1.0, 1.0, 1.0], 0), (5, [float("nan")] * 5, 0), (6, [float("inf")] * 5, 0)]
    rows += bad + rows[:40] + [(None, [9.0] * 5, 0), (None, [1e30, -1e30, 0.0, 1e5, -1e5], 0)]
    table_ = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int")
    kept = [(i, np.clip(np.floor(np.array(v) * 64), -(1 << 26), 1 << 26).astype(int).tolist()) for i, v, _ in rows if (i, v, 0) not in bad]
    hashed = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes()))
    centers = [v for _, v in hashed[:7]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centers))

    for _ in range(4):
        mine = [[] for _ in centers]
        for _, v in kept:
            mine[nearest(v)[1]].append(v)
        centers = [[sum(c) // len(m) for c in zip(*m, strict=True)] if m else c for m, c in zip(mine, centers, strict=True)]
    want, inertia = [], [0] * 7
    for i, v in kept:
        d, n = nearest(v)
        inertia[n] += d
        want.append((i, n, d))
    want = [(i, n, d, inertia[n], sum(inertia), hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for i, n, d in want]
    got = centroids.cluster_vectors(table_, k=7, rounds=4, dims=5)
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.collect())
    few = centroids.cluster_vectors(table_.where("vec_id < 5 AND size(embedding) = 5"), k=7, dims=5)
    assert few.count() and all(r.distance == 0 or r.cluster >= 0 for r in few.collect())


def test_bounds_leave_most_vectors_closed():
    """Far-off clusters are told apart by their cells alone, and bounds hold for every vector."""
    rng = np.random.default_rng(5)
    centers = rng.integers(-300, 300, (16, 64))
    values = centers[rng.integers(0, 16, 5000)] + rng.integers(-40, 40, (5000, 64))
    counts = np.array([np.bincount(centroids.bin_of(c), minlength=2 * centroids.FINE) for c in values.T])
    bounds = centroids.cell_bounds(counts)
    assert (bounds[:, 0] <= values.min(0)).all() and (bounds[:, -1] > values.max(0)).all()
    cells = centroids.cells_of(values, bounds)
    near = centroids.Approximation(bounds, centers)
    packed = centroids._binary(values.astype("<i4"))
    assert near.nearest(cells, centroids.Vectors(packed, 64)).tolist() == centroids.squared(values, centers).argmin(1).tolist()
    assert near.compared < 0.05 * len(values)
    # Without clusters too most vectors are told apart: directions at random, as the driver's vectors are.
    wild = rng.normal(size=(4000, 64))
    wild = np.floor(64 * wild / np.linalg.norm(wild, axis=1, keepdims=True)).astype(int)
    bounds = centroids.cell_bounds(np.array([np.bincount(centroids.bin_of(c), minlength=2 * centroids.FINE) for c in wild.T]))
    cells = centroids.cells_of(wild, bounds)
    assert (centroids.unpack_cells(centroids.pack_cells(cells), 64) == cells).all()
    near = centroids.Approximation(bounds, wild[:16])
    assert near.nearest(cells, centroids.Vectors(centroids._binary(wild.astype("<i4")), 64)).tolist() == centroids.squared(wild, wild[:16]).argmin(1).tolist()
    assert near.compared < 0.5 * len(wild)


def test_bins_are_monotone_and_start_where_they_say():
    starts = centroids.bin_starts()
    values = np.unique(np.concatenate([starts, starts - 1, np.arange(-5000, 5000), [centroids.LARGEST, -centroids.LARGEST]]))
    values = values[np.abs(values) <= centroids.LARGEST]
    bins = centroids.bin_of(values)
    assert ((starts[bins] <= values) & (values < starts[bins + 1])).all()


def print_of(text):
    from xxhash import xxh64_intdigest

    words = words_of((text or "").translate(LOW))
    shingles = [" ".join(words[k : k + 4]) for k in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints, near=4):
    """The smallest index that each print reaches, by all distances."""
    values, root = np.array(prints, np.uint64), np.arange(len(prints))
    for n in range(len(prints)):
        mine = np.flatnonzero(np.bitwise_count(values ^ values[n]) <= near)
        same = np.isin(root, root[mine])
        root[same] = root[same].min()
    return root.tolist()


def test_prints_and_components_of_documents(docs, raw):
    ordered = sorted(raw)
    prints = [print_of(t) for _, t in ordered]
    want = sorted((i, f"{p:016x}", ordered[r][0]) for (i, _), p, r in zip(ordered, prints, roots(prints), strict=True))
    assert sorted(tuple(r) for r in simhash.near_components(docs).collect()) == want
    assert any(i != r for i, _, r in want)


def test_prints_of_odd_rows(odd):
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is None, r[0]))
    prints = [print_of(t) for _, t in rows]
    want = [(i, f"{p:016x}", rows[r][0]) for (i, _), p, r in zip(rows, prints, roots(prints), strict=True)]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in simhash.near_components(odd).collect())


@pytest.mark.parametrize("most", [1 << 16, 25, 3])
def test_every_way_finds_the_components(spark, most):
    """Balls of close prints: buckets held whole, split once more, and met in midpoints."""
    rng, prints = random.Random(3), set()
    for _ in range(5):
        base = rng.getrandbits(64)
        for _ in range(80):
            one = base
            for _ in range(rng.randint(0, 8)):
                one ^= 1 << rng.randrange(64)
            prints.add(one)
    ordered = sorted(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in ordered], "print long")
    place = {p: n for n, p in enumerate(ordered)}
    root = np.arange(len(ordered))
    for r in simhash.links(df, most=most).collect():
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        assert bin(a ^ b).count("1") <= 4
        same = np.isin(root, root[[place[a], place[b]]])
        root[same] = root[same].min()
    assert root.tolist() == roots(ordered)


def test_majority_of_many_hashes():
    rng = np.random.default_rng(2)
    sizes = np.array([0, 1, 2, 255, 256, 1000, 0])
    hashes = rng.integers(0, 1 << 64, sizes.sum(), np.uint64)
    at, want = 0, []
    for n in sizes.tolist():
        part = hashes[at : at + n].tolist()
        want.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in part) > n))
        at += n
    assert simhash.majority(hashes, sizes).tolist() == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert periodic_runs.collapsed_digest(docs).count() == simhash.near_components(docs).count() == 0
    vectors = centroids.cluster_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"))
    full = centroids.cluster_vectors(spark.createDataFrame([(1, [0.5] * 64)], "vec_id long, embedding array<float>"))
    assert vectors.count() == 0 and vectors.dtypes == full.dtypes and full.count() == 1
