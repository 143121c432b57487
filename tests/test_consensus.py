"""Consensus signals: recall against brute force, families with many members, session edges, incremental labels."""

import math
import random
from collections import defaultdict

from pyspark.sql import functions as F

from pressgauge.operators import graph
from pressgauge.plans import consensus
from testbed import tables as T

SMALL = "/root/testdata/sf0.01"


def _grams(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_links_are_exact_and_recall_is_high(spark):
    """Every row whose id is divisible by 100, and with them all others, against all rows."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    first = {}
    for r in docs.orderBy("doc_id").collect():
        first.setdefault(r.text, r.doc_id)
    sets = {i: _grams(t) for t, i in first.items()}
    holders = defaultdict(set)
    for i, s in sets.items():
        for g in s:
            holders[g].add(i)
    want = set()
    for i, s in sets.items():
        for j in {j for g in s for j in holders[g]} - {i}:
            if len(s & sets[j]) >= 0.8 * len(s | sets[j]):
                want.add((i, j))
    texts = docs.groupBy("text").agg(F.min("doc_id").alias("id")).select("id", "text")
    links = {tuple(r) for r in consensus.similar_texts(texts).collect()}
    assert links <= want
    clusters = {r.cluster_id: r for r in consensus.text_clusters(docs).groupBy("cluster_id").count().collect()}
    part = {r.id: r.part for r in graph.components(spark.createDataFrame(sorted(links), "a long, b long")).collect()}
    joined = [(a, b) for a, b in want if part.get(a, a) == part.get(b, b)]
    asked = [(a, b) for a, b in want if a % 100 == 0]
    assert len(joined) >= 0.99 * len(want) and len([p for p in asked if p in set(joined)]) >= 0.9 * len(asked)
    assert len(clusters) == len({part.get(i, i) for i in sets})


def test_a_large_family_costs_a_few_links_a_member(spark):
    rng = random.Random(4)
    base = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(600):  # near copies, each with two words of its own
        words = list(base)
        words[rng.randrange(200)], words[rng.randrange(200)] = f"own{i}", f"more{i}"
        rows.append((i, " ".join(words)))
    texts = spark.createDataFrame([*rows, (1000, None), (1001, ""), (1002, "one two"), (1003, "One  two")], "id long, text string")
    links = consensus.similar_texts(texts, hubs=3)
    half = consensus.similar_texts(texts.where("id < 300"), hubs=3).count()
    assert links.count() <= 2.5 * half and links.count() < 0.05 * 600 * 599
    parts = graph.components(links).collect()
    assert {r.part for r in parts if r.id < 600} == {0} and len([r for r in parts if r.id < 600]) == 600
    assert {(r.id, r.part) for r in parts if r.id >= 600} == {(1002, 1002), (1003, 1002)}


def _star(spark, variants=90):
    """A text no hub order puts first, and variants like it of which hardly two are alike."""
    rng = random.Random(9)
    ids = [r.id for r in spark.range(variants + 1).orderBy(F.xxhash64("id").desc()).collect()]
    base, rows = [f"word{i}" for i in range(200)], []
    for i in ids[1:]:
        words = list(base)
        for at in rng.sample(range(5, 195, 6), 4):
            words[at] = f"own{i}at{at}"
        rows.append((i, " ".join(words)))
    return ids[0], [(ids[0], " ".join(base)), *rows]


def _parts(links):
    """The least member of each member's group, by brute force."""
    part = {}
    for a, b in links:
        one, two = part.setdefault(a, a), part.setdefault(b, b)
        for k in [k for k, v in part.items() if v in (one, two)]:
            part[k] = min(one, two)
    return part


def _like(rows, least=0.8):
    sets = {i: _grams(t) for i, t in rows}
    return {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j])}


def test_members_that_no_hub_is_like_are_compared_too(spark):
    centre, rows = _star(spark)
    want = _like(rows)
    assert len(want) < 1.5 * len(rows) and all((min(i, centre), max(i, centre)) in want for i, _ in rows if i != centre)
    docs = spark.createDataFrame([(i, t, "xyz"[i % 3]) for i, t in rows], "doc_id long, text string, source string").withColumn("seen_at", F.timestamp_seconds(F.lit(0)))
    got = [(r.cluster_id, r["items"], r.sources) for r in consensus.coordinated_text(docs).collect()]
    assert got == [(0, len(rows), 3)]


def test_blocks_and_passes_leave_no_pair_out(spark, monkeypatch):
    monkeypatch.setattr(consensus, "SETS", 8)
    monkeypatch.setattr(consensus, "PASSES", (1, 2, None))
    passes, named = [], consensus.cell_pairs
    monkeypatch.setattr(consensus, "cell_pairs", lambda placed, least, most: passes.append(most) or named(placed, least, most))
    _, rows = _star(spark, 60)
    rows = [(f"k{i:03}", t) for i, t in rows]  # keys need not be numbers
    rows += [(f"m{i:03}", " ".join(f"word{k}" for k in range(100 + i // 2)) + f" end{i}") for i in range(40)]
    want = _like(rows)
    links, parts = consensus.linked_sets(consensus.text_sets(spark.createDataFrame(rows, "id string, text string")), hubs=2)
    assert {tuple(r) for r in links.collect()} <= want and passes[0] == 1
    assert {r.id: r.part for r in parts.collect()} == _parts(want)


def test_cells_name_all_pairs_of_other_parts(spark):
    rng = random.Random(3)
    ids = list(range(50))
    sets = [(i, sorted({rng.randrange(60) for _ in range(rng.randrange(20, 90))})) for i in ids]
    sets = spark.createDataFrame([(i, g, len(g)) for i, g in sets], "id long, grams array<long>, n int")
    marks = {r.id: r for r in consensus.parities(sets).collect()}
    met = spark.createDataFrame([(b, i, marks[i].n, [(90, 1), (91, 1)]) for b in (1, 2, 3) for i in ids if i % b == 0], "bucket long, id long, n int, hubs array<struct<id: long, n: int>>")
    parts = spark.createDataFrame([(i, i % 2) for i in ids if i < 30 or i % 3 == 0], "id long, part long")
    part = {i: i % 2 if i < 30 or i % 3 == 0 else i for i in ids}
    want = set()
    for i in ids:
        for j in ids[i + 1 :]:
            n, apart = marks[i].n + marks[j].n, sum((x ^ y) % 2**64 != 0 and ((x ^ y) % 2**64).bit_count() for x, y in zip(marks[i].marks, marks[j].marks))
            if part[i] != part[j] and min(marks[i].n, marks[j].n) >= 0.4 * max(marks[i].n, marks[j].n) and (n - apart) / 2 >= (n - (n - apart) / 2) * 0.4:
                want.add((i, j))
    assert 100 < len(want) < 1000
    marked = spark.createDataFrame([(r.id, r.marks) for r in marks.values()], "id long, marks array<long>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for block in (5, 100):
            cells = consensus.beyond_hubs(met, parts, block).join(marked, "id")
            assert cells.groupBy("cell").count().agg(F.max("count")).first()[0] <= (50 if block == 100 else 40)
            assert {tuple(r) for r in consensus.cell_pairs(cells, 0.4, None).collect()} == want
            few = [tuple(r) for r in consensus.cell_pairs(cells, 0.4, 1).collect()]
            assert (None, None) in few and {f for f in few if f[0] is not None} < want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    together = met.withColumn("part", F.lit(0).cast("long")).select("id", "part").distinct()
    assert consensus.beyond_hubs(met, together, 5).count() == 0


def test_sets_and_bands_are_worked_out_once(spark, monkeypatch):
    plans = {}

    def seen(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return graph.written(df, label)

    monkeypatch.setattr(consensus, "written", seen)
    rows = [(1, "one two three four five six"), (2, "one two three four five six"), (3, None), (4, " \n\x0b"), (5, "\u0085"), (6, "\u0085")]
    links = consensus.similar_texts(spark.createDataFrame(rows, "id long, text string"))
    assert sorted(map(tuple, links.collect())) == [(1, 2), (5, 6)]
    assert plans["shingles"].count("split(") == 1 and "array_sort" not in plans["shingles"]
    assert "lambda" not in plans["pairs"]


def test_bitmaps_rule_out_pairs_before_their_sets_are_fetched(spark, monkeypatch):
    rng = random.Random(8)
    lists = {i: [f"w{rng.randrange(10**6)}" for _ in range(300)] for i in range(0, 60, 3)}
    for i in list(lists):  # a near copy of each text, and one that has half its words
        lists[i + 1], lists[i + 2] = lists[i][:290], lists[i][:150] + [f"v{rng.randrange(10**6)}" for _ in range(150)]
    tables = {}
    monkeypatch.setattr(consensus, "written", lambda df, label: tables.setdefault(label, graph.written(df, label)))
    texts = [(i, " ".join(words)) for i, words in lists.items()]
    links = consensus.similar_texts(spark.createDataFrame([*texts, (1000, ""), (1001, None)], "id long, text string"))
    assert {tuple(r) for r in links.collect()} == {(i, i + 1) for i in range(0, 60, 3)}
    assert tables["pairs"].count() > 30 and {tuple(r) for r in tables["candidates"].collect()} == {(i, i + 1) for i in range(0, 60, 3)}
    held = {r.id: (set(r.grams), r.marks) for r in tables["shingles"].join(tables["marks"], "id").collect()}
    apart = {i: sum((x ^ y).bit_count() if x ^ y >= 0 else ((x ^ y) % 2**64).bit_count() for x, y in zip(held[i][1], held[i + 2][1])) for i in range(0, 60, 3)}
    assert all(0 < apart[i] <= len(held[i][0] ^ held[i + 2][0]) for i in apart)


def test_bands_are_those_of_the_least_hashes(spark):
    rng = random.Random(6)
    low, high = -(2**63), 2**63 - 1
    sets = [[low], [high], [-1], [0], [low, high], [-1, 0], *(sorted({rng.randrange(low, high) for _ in range(n)}) for n in (2, 5, 30, 64, 400))]

    def signature(grams):
        return [next((g for g in grams if g >> 58 >= b), grams[0]) for b in range(-32, 32)]

    want = F.array(*(F.xxhash64(F.lit(j), *(F.get("signature", F.lit(3 * j + k)) for k in range(3))) for j in range(21)))
    rows = spark.createDataFrame([(g, signature(g)) for g in sets], "grams array<long>, signature array<long>")
    assert rows.select(consensus.bands(F.slice("grams", 1, 0)).alias("got")).where("got is not null").count() == 0
    assert all(r.got == r.want for r in rows.select(consensus.bands(F.col("grams")).alias("got"), want.alias("want")).collect())


def test_sessions_split_at_the_gap(spark):
    rows = [("a", "s1", 0), ("a", "s2", 100), ("a", "s1", 200), ("a", "s3", 301), ("a", None, 350), ("b", "s1", 5), ("b", "s1", 99), ("b", "s1", 199)]
    seen = spark.createDataFrame(rows, "grp string, source string, t int").select("grp", "source", F.timestamp_seconds("t").alias("ts"))
    got = consensus.sessions(seen, "grp", "source", "ts", 100).collect()
    stamp = lambda r: (r.grp, int(r.first_seen.timestamp()), r.span_seconds, r["items"], r.sources)
    zero = min(int(r.first_seen.timestamp()) for r in got)
    assert sorted((g, f - zero, *rest) for g, f, *rest in map(stamp, got)) == [("a", 0, 200, 3, 2), ("a", 301, 49, 2, 1), ("b", 5, 194, 3, 1)]


def test_coordinated_text_leaves_single_sources_and_missing_times_out(spark):
    text = "one and the same story told in many places at once by all of them"
    rows = [(1, text, "x", 0), (2, text + " indeed", "y", 50), (3, text, "z", 10**6), (4, "something else", "x", 0), (5, text, "w", None), (6, None, "x", 0), (7, None, "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, t int").withColumn("seen_at", F.timestamp_seconds("t"))
    got = sorted((r.cluster_id, r["items"], r.sources, r.span_seconds) for r in consensus.coordinated_text(docs).collect())
    assert got == [(1, 2, 2, 50), (6, 2, 2, 1)]
    assert consensus.coordinated_text(docs.limit(0)).count() == 0


def test_vector_recall_and_exactness(spark):
    vectors = T.voiced_vectors(spark, SMALL).selectExpr("vec_id as id", "embedding as vector")
    held = {r.id: r.vector for r in vectors.collect()}
    norm = {i: math.sqrt(sum(x * x for x in v)) for i, v in held.items()}
    cos = lambda a, b: sum(x * y for x, y in zip(held[a], held[b])) / norm[a] / norm[b]
    links = [tuple(r) for r in consensus.similar_vectors(graph.written(vectors, "v"), 0.9).collect()]
    assert all(cos(a, b) >= 0.9 - 1e-9 for a, b in links)
    part = {r.id: r.part for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = [(a, b) for a in held if a % 100 == 0 for b in held if a != b and cos(a, b) >= 0.9]
    assert want and sum(part.get(a, a) == part.get(b, b) for a, b in want) >= 0.9 * len(want)


def test_hot_buckets_are_split_and_hubs_serve_the_rest(spark):
    rng = random.Random(2)
    centre = [rng.gauss(0, 1) for _ in range(16)]
    near = [(i, [x + rng.gauss(0, 1e-9) for x in centre]) for i in range(300)]  # no hyperplane tells these apart
    spread = [(1000 + i, [rng.gauss(0, 1) for _ in range(16)]) for i in range(300)]
    vectors = graph.written(spark.createDataFrame([*near, *spread, (5000, [0.0] * 16)], "id long, vector array<double>"), "v")
    small, hot = consensus.split_buckets(graph.written(consensus.sketch_vectors(vectors, 16, 4, 7), "s"), 2, 20)
    assert {r.id for r in hot.select("id").distinct().collect()} >= set(range(300))
    assert small.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 20
    links = consensus.similar_vectors(vectors, 0.99, tables=4, bits=2, most=20)
    assert links.count() <= 4 * 3 * 300
    parts = {r.id: r.part for r in graph.components(links).collect()}
    assert {parts[i] for i in range(300)} == {0} and 5000 not in parts


def test_vectors_that_no_hub_is_near_are_compared_too(spark, monkeypatch):
    monkeypatch.setattr(consensus, "VECTORS", 16)
    rng = random.Random(12)
    centre = [rng.gauss(0, 1) for _ in range(16)]
    rows = []
    for k in range(40):  # groups of three that no hyperplane tells apart, a little too far from each other
        middle = [x + rng.gauss(0, 1e-6) for x in centre]
        rows += [(3 * k + i, [x + rng.gauss(0, 1e-9) for x in middle]) for i in range(3)]
    vectors = graph.written(spark.createDataFrame(rows, "id long, vector array<double>"), "v")
    small, hot = consensus.split_buckets(graph.written(consensus.sketch_vectors(vectors, 16, 4, 7), "s"), 2, 20)
    assert hot.select("id").distinct().count() == 120
    for forest in (False, True):
        parts = {r.id: r.part for r in graph.components(consensus.similar_vectors(vectors, 1 - 1e-14, tables=4, bits=2, most=20, forest=forest)).collect()}
        assert parts == {i: i - i % 3 for i in range(120)}


def test_consensus_counts_copies_and_voices(spark):
    rows = [(1, [1.0, 0.0], 1), (2, [1.0, 0.0], 2), (3, [0.99, 0.01], 2), (4, [0.0, 1.0], 1), (5, [0.0, 1.0], 1), (6, None, 3), (7, [0.0, 0.0], 1), (8, [0.0, 0.0], 2)]
    got = consensus.semantic_consensus(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert sorted((r.cluster_id, r["items"], r.voices) for r in got) == [(1, 3, 2), (7, 2, 2)]


def test_labels_carry_on_and_move_only_by_links(spark):
    nodes = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    links = lambda *pairs: spark.createDataFrame(list(pairs), "a long, b long")
    table = lambda df: {r.id: r.part for r in df.collect()}
    none = spark.createDataFrame([], "id long, part long")
    first = graph.extend_components(none, links((5, 6), (8, 9)), nodes(5, 6, 7, 8, 9))
    assert table(first) == {5: 5, 6: 5, 7: 7, 8: 8, 9: 8}
    second = graph.extend_components(first, links((1, 2), (9, 7)), nodes(1, 2, 7))
    assert table(second) == {1: 1, 2: 1, 5: 5, 6: 5, 7: 7, 8: 7, 9: 7}
    both = graph.components(links((5, 6), (8, 9), (1, 2), (9, 7)))
    assert {k: v for k, v in table(second).items()} == table(both)
    assert table(graph.extend_components(second, links(), nodes())) == table(second)


def test_vectors_meet_inside_their_buckets(spark, monkeypatch):
    """Links equal brute force however batches cut the buckets; a cluster costs a link a member and table, not one a pair."""
    rng = random.Random(5)
    centre = [rng.gauss(0, 1) for _ in range(16)]
    rows = [(i, [x + rng.gauss(0, 0.2) for x in centre]) for i in range(240)] + [(300, [0.0] * 16), (301, [2 * x for x in centre]), (302, [-x for x in centre])]
    vectors = graph.written(spark.createDataFrame(rows, "id long, vector array<double>"), "v")
    held = dict(rows)
    cos = lambda a, b: sum(x * y for x, y in zip(held[a], held[b])) / math.dist(held[a], [0] * 16) / math.dist(held[b], [0] * 16)
    buckets = [(b, i) for b in (7, -7) for i in held if i % 2 == (b > 0) or i < 20]
    want = {(a, b) for k in (7, -7) for x, a in buckets if x == k for y, b in buckets if y == k and a < b and 300 not in (a, b) and cos(a, b) >= 0.95}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        placed = spark.createDataFrame(buckets, "bucket long, id long")
        every = {tuple(r) for r in consensus.bucket_links(placed, vectors, 0.95).collect()}
        few = [tuple(r) for r in consensus.bucket_links(placed, vectors, 0.95, forest=True).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert every == want and set(few) <= want and len(few) < len(buckets)
    parts = lambda links: {r.id: r.part for r in graph.components(spark.createDataFrame(sorted(links), "a long, b long")).collect()}
    assert parts(set(few)) == parts(want)

    handed = []
    monkeypatch.setattr(consensus, "components", lambda links: handed.append(links.count()) or graph.components(links))
    consensus.vector_clusters(vectors.select(F.col("id").alias("vec_id"), F.col("vector").alias("embedding")), least=0.5, tables=4, bits=1).count()
    assert handed[0] <= 4 * 242
