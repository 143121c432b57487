"""Importance resampling: against the definition, and the cut against a full sort."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from llm_rows import HOSTILE
from pressgauge.llm import resample

SF_DIR = "/root/testdata/sf0.001"


def runs(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def by_definition(rows, target, least=20, percent=5):
    corpus, aim = Counter(), Counter()
    found = [runs(t) for _, t in rows]
    for _, f in found:
        corpus.update(f)
    for t in target:
        aim.update(runs(t)[1])
    s, t = sum(corpus.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s + 10000) / ((corpus[b] + 1) * (t + 10000)))) for b in corpus}
    out = []
    for (key, _), (n, f) in zip(rows, found):
        h = int(hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], 2**63 if r[0] is None else r[0]))
    for place, row in enumerate(fit[: len(fit) * percent // 100], 1):
        row[4] = place
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((list(r) for r in df.collect()), key=repr)


def test_equals_the_definition(spark):
    docs, target = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "benchmark"))
    rows, aim = [(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()]
    assert rows_of(resample.resample(docs, target)) == by_definition(rows, aim)
    assert rows_of(resample.resample(docs, target, percent=60, group=5)) == by_definition(rows, aim, percent=60)


def test_awkward_and_empty_tables(spark, hostile, nothing):
    target = spark.createDataFrame([(1, "the general public license"), (2, None), (3, "")], "item_id long, text string")
    # which of two equal rows is drawn at the cut is open; everything is drawn here or nothing is
    for percent in (0, 100):
        got = rows_of(resample.resample(hostile, target, percent=percent, least_words=2))
        want = by_definition(HOSTILE, ["the general public license"], 2, percent)
        assert [r[:4] + r[5:] for r in got] == [r[:4] + r[5:] for r in want]
        assert sorted(r[4] for r in got if r[4]) == sorted(r[4] for r in want if r[4])
    assert resample.resample(nothing, target).count() == 0
    assert rows_of(resample.resample(hostile, nothing.selectExpr("doc_id as item_id", "text"))) == by_definition(HOSTILE, [])


@pytest.mark.parametrize("group", [3, 64, 1 << 16])
def test_cut_is_the_kth_key(spark, group, tmp_path):
    """Many ties, and a third of all rows with one key."""
    keys = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(40))).cast("long").alias("score"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("id"),
    )
    keys.repartition(7).write.parquet(str(tmp_path / "keys"))
    keys = spark.read.parquet(str(tmp_path / "keys"))
    ordered = sorted(((r.score, r.id) for r in keys.collect()), key=lambda r: (-r[0], r[1]))
    for k in (1, 2, 450, 640, 899, 900):
        assert resample.cutoff(keys, k, group) == ordered[k - 1]
    assert resample.cutoff(keys, 0, group) is None


def test_ranks_are_gapless_over_ranges(spark):
    rows = spark.range(500).select(F.pmod(F.xxhash64("id"), F.lit(9)).alias("score"), F.col("id").alias("doc_id"))
    got = resample.ranks(rows, [F.col("score").desc(), F.col("doc_id")]).collect()
    want = sorted(((r.score, r.doc_id) for r in got), key=lambda r: (-r[0], r[1]))
    assert [(r.score, r.doc_id) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 501))


def test_equal_rows_at_the_cut(spark, nothing):
    docs = spark.createDataFrame([(1, "same words " * 20)] * 40, "doc_id long, text string")
    got = resample.resample(docs, nothing.selectExpr("doc_id as item_id", "text"), percent=25).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 11)) and len(got) == 40
