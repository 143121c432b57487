"""Bit-sliced SimHash: fingerprints, distances and components against brute force."""

import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from llm_rows import HOSTILE
from pressgauge.llm import bitsliced, graph

SF_DIR = "/root/testdata/sf0.001"


def simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def parts(nodes, linked):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        parent[top(a)] = top(b)
    return {n: top(n) for n in nodes}


def near(nodes, radius=4):
    return [(a, b) for a, b in combinations(nodes, 2) if (a ^ b).bit_count() <= radius]


def grouped(of):
    out = defaultdict(set)
    for n, p in of.items():
        out[p].add(n)
    return set(map(frozenset, out.values()))


def by_definition(rows):
    fps = [simhash(t) for _, t in rows]
    of = parts(set(fps), near(sorted(set(fps))))
    least = {}
    for (key, _), f in zip(rows, fps):
        if key is not None:
            least[of[f]] = min(key, least.get(of[f], key))
    return sorted(((key, f"{f:016x}", least.get(of[f])) for (key, _), f in zip(rows, fps)), key=repr)


def family(rng, centre, n, most):
    return np.array([int(centre) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, most + 1), replace=False)) for _ in range(n)], np.uint64)


def test_equals_the_definition(spark, hostile, nothing):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = sorted((tuple(r) for r in bitsliced.near_duplicates(docs).collect()), key=repr)
    assert got == by_definition([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted((tuple(r) for r in bitsliced.near_duplicates(hostile).collect()), key=repr) == by_definition(HOSTILE)
    assert bitsliced.near_duplicates(nothing).count() == 0


@pytest.mark.parametrize("radius", [1, 2, 3, 4, 5, 7])
def test_lane_counters(radius):
    rng = np.random.default_rng(radius)
    fps = np.concatenate([rng.integers(0, 2**64, 90, dtype=np.uint64), family(rng, 2**40 + 5, 102, 9)])
    masks = bitsliced.within(bitsliced.planes_of(fps.reshape(-1, 64)), fps, radius)
    got = bitsliced._spread(masks).reshape(len(fps), -1)
    assert (got == [[(int(a) ^ int(b)).bit_count() <= radius for b in fps] for a in fps]).all()


@pytest.mark.parametrize("nodes", [1, 10**5, 10**7, 10**9, 10**11])
def test_near_fingerprints_share_a_block_mask(nodes):
    masks = bitsliced.block_masks(nodes)
    assert 64 << min(m.bit_count() for m in masks) >= nodes
    rng = np.random.default_rng(1)
    for _ in range(500):
        change = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(change & m == 0 for m in masks)


def test_forests_keep_every_component():
    rng = np.random.default_rng(5)
    fps = np.unique(np.concatenate([rng.integers(0, 2**64, 300, dtype=np.uint64), *(family(rng, c, n, 4) for c, n in ((7, 700), (2**63, 60), (2**50, 9)))]))
    rng.shuffle(fps)
    key = np.sort(np.concatenate([np.zeros(500, np.int64), rng.integers(1, 40, len(fps) - 500)]))
    links = [(int(a), int(b)) for pair in bitsliced.forests(key, fps) for a, b in zip(*pair)]
    want = [p for k in set(key.tolist()) for p in near([int(f) for f in fps[key == k]])]
    nodes = [int(f) for f in fps]
    assert grouped(parts(nodes, links)) == grouped(parts(nodes, want))
    assert len(links) < len(fps)


def test_links_over_batches_and_hot_buckets(spark):
    rng = np.random.default_rng(9)
    fps = np.unique(np.concatenate([rng.integers(0, 2**64, 400, dtype=np.uint64), family(rng, 99, 900, 3), family(rng, 2**60 + 1, 50, 8)]))
    nodes = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")  # buckets reach over many batches
    try:
        links = [(r.a % 2**64, r.b % 2**64) for r in bitsliced.near_links(nodes).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    ids = [int(f) for f in fps]
    assert grouped(parts(ids, links)) == grouped(parts(ids, near(ids)))


def test_components_of_long_and_tangled_graphs(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 180)] + [(200 + i, 200 + j) for i in range(9) for j in range(9)] + [(300, 300)]
    got = {r.id: r.part for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 180)}, **{i: 200 for i in range(200, 209)}}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
    with pytest.raises(RuntimeError):
        graph.components(spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long"), rounds=1)
