"""Operators 2, 7 and 10: against SQL, on awkward rows and by their laws."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressgauge.llm import license_join, splitters, winnow
from pressgauge.llm.queries import ORACLE, REGISTRY
from testbed.check import _rows, duck

from llm_rows import HOSTILE

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    df, cur = REGISTRY[name](spark, SF_DIR), duck(SF_DIR).execute(ORACLE[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, df.collect()) == _rows(columns, cur.fetchall())


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_licenses_on_awkward_rows(spark, hostile, nothing):
    rows = license_join.scan_licenses(spark, hostile).collect()
    assert Counter((r.doc_id, r.n_words) for r in rows) == Counter((i, len(words(t))) for i, t in HOSTILE)
    assert [(r.n_base, r.first_word, r.last_word, r.labels) for r in rows if r.doc_id == 8] == [(2, 1, 5, "gpl")]
    assert {(r.base_labels, r.labels, r.n_notice_blocks) for r in rows if r.doc_id == 1} == {("mit", "mit", 1)}
    assert license_join.scan_licenses(spark, nothing).count() == 0


def test_notice_found_by_containment_alone(spark):
    docs = spark.createDataFrame([(1, "text\nlicensed, by us, under cc by-nc 4.0"), (2, "licensed under nothing")], "doc_id long, text string")
    found = {r.doc_id: r.labels for r in license_join.scan_licenses(spark, docs).collect()}
    assert found == {1: "cc-by-nc", 2: ""}


def test_winnowing_on_awkward_rows(spark, hostile, nothing):
    items = [(1, "c d e f g h i j k l m"), (2, "w1 w2 w3"), (3, None), (4, ""), (None, "FOX jumps"), (2, "w1 w2 w3"), (5, "q r s t u v w x y aa")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = winnow.decontaminate(hostile, benchmark).collect()

    def brute(text):
        w, hit, names = words(text), set(), set()
        for item, t in items:
            m = words(t)
            size = min(10, len(m))
            wins = {tuple(m[i : i + size]) for i in range(len(m) - size + 1)} if m else set()
            for i in range(len(w) - size + 1 if m else 0):
                if tuple(w[i : i + size]) in wins:
                    hit |= set(range(i, i + size))
                    names.add("" if item is None else str(item))
        return len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)

    assert Counter(tuple(r) for r in rows) == Counter((i, *brute(t)) for i, t in HOSTILE)
    assert winnow.decontaminate(nothing, benchmark).count() == 0
    assert winnow.decontaminate(hostile, benchmark.limit(0)).where("contaminated").count() == 0
    kept = winnow.clean(hostile, benchmark)
    assert kept.columns == hostile.columns and kept.count() == sum(not r.contaminated for r in rows)


def test_shards_obey_the_law(spark, hostile, nothing):
    rows = splitters.assign_shards(hostile).collect()
    expect = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in HOSTILE)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == expect
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert splitters.assign_shards(nothing).count() == 0


def test_hot_text_is_divided_and_sizes_are_even(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "case when id % 3 = 0 then repeat('hot ', 50) else repeat(string(id), 40) end as text")
    rows = splitters.assign_shards(docs, ranges=64, per_range=16).collect()
    size = Counter()
    for r in rows:
        size[r.shard] += r["size"]
    mean = sum(size.values()) / 8
    assert len(size) == 8 and max(abs(v - mean) for v in size.values()) < 0.02 * mean
    apart = Counter(r.text_crc32 for r in {(r.text_crc32, r.shard): r for r in rows if r.doc_id % 3}.values())
    assert max(apart.values()) == 1  # equal texts share a shard unless they overfill a range


def test_texts_of_less_than_a_twentieth_of_a_shard_stay_whole(spark):
    docs = spark.createDataFrame([(i, f"text {i % 200} " + "word " * 20) for i in range(4000)], "doc_id long, text string")
    rows = splitters.assign_shards(docs).collect()  # 200 texts of 0.5 % each, far over a fine range
    shards_of = {}
    for r in rows:
        shards_of.setdefault(r.text_crc32, set()).add(r.shard)
    assert len(shards_of) == 200 and all(len(s) == 1 for s in shards_of.values())
    sizes = [sum(r["size"] for r in rows if r.shard == s) for s in range(8)]
    assert max(sizes) - min(sizes) <= 0.1 * sum(sizes) / 8
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))


def test_short_items_in_repeating_documents(spark):
    text = "a " * 6000 + "b"
    docs = spark.createDataFrame([(1, text), (1, text), (2, "c " * 5000), (3, "a b " * 3000)], "doc_id long, text string")
    benchmark = spark.createDataFrame([("x", "a"), ("y", "a b"), ("z", "a " * 12)], "item_id string, text string")
    hits = winnow.hit_windows(docs.select("doc_id", "text", F.crc32("text").alias("key")), winnow._items(benchmark))
    assert hits.groupBy("doc_id", "item_id").count().collect() and hits.where("doc_id = 1").groupBy("item_id").count().where("item_id = 'x'").first()["count"] == 6000
    rows = sorted(tuple(r)[:4] for r in winnow.decontaminate(docs, benchmark).collect())
    assert rows == [(1, 6001, 6001, 3), (1, 6001, 6001, 3), (2, 5000, 0, 0), (3, 6000, 6000, 2)]
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" in plan  # one row for a document and an item
