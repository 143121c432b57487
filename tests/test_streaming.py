"""Streaming jobs end equal to their batch twins and survive replays."""

import json
import time

from pyspark.sql import functions as F

from pressgauge.functions.tactics import response_tactics
from pressgauge.operators import dedup, queue
from pressgauge.plans import marts
from pressgauge.streaming import jobs


def _land(spark, rows, schema, path):
    """One file per list of rows, in order."""
    for part in rows:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.05)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(str(path))


CANDIDATE = "content_hash string, source_type string, fetched_at int, phase int, feed_ordinal int, item_pos int"


def _candidate_batches():
    return [[(f"h{(i * 7) % 40}" if i % 3 else "hot", "rss_article", b, 0, i % 4, i) for i in range(b * 30, b * 30 + 30)] for b in range(4)]


def test_candidates_equal_batch_first_wins_and_replay(spark, tmp_path):
    batches = _candidate_batches()
    stream = _land(spark, batches, CANDIDATE, tmp_path / "in")
    out = str(tmp_path / "out")
    jobs.stream_candidates(stream, out, str(tmp_path / "ck1")).awaitTermination()
    everything = spark.createDataFrame([r for b in batches for r in b], CANDIDATE)
    want = sorted(tuple(r) for r in dedup.first_wins(everything, ["content_hash"], dedup.ORDER).collect())

    def stored():
        return sorted(tuple(r)[:6] for r in spark.read.parquet(out).collect())

    assert stored() == want
    # every batch is run a second time, as after the loss of the offset log
    jobs.stream_candidates(stream, out, str(tmp_path / "ck2")).awaitTermination()
    assert stored() == want
    # later copies of known texts change nothing, new texts arrive
    _land(spark, [[("hot", "rss_article", 9, 0, 0, 0), ("fresh", "rss_article", 9, 0, 0, 1)]], CANDIDATE, tmp_path / "in")
    jobs.stream_candidates(stream, out, str(tmp_path / "ck2")).awaitTermination()
    assert stored() == sorted(want + [("fresh", "rss_article", 9, 0, 0, 1)])


def test_status_log(spark, tmp_path):
    schema = "item_id long, seq long, status string, processed_at timestamp, error_message string"
    at = None
    batches = [
        [(1, 1, "processing", at, None), (9, 2, "processing", at, None)],
        [(1, 3, "error", at, "boom"), (2, 4, "done", at, None)],
    ]
    stream = _land(spark, batches, schema, tmp_path / "in")
    known = spark.createDataFrame([(1,), (2,), (3,)], "item_id long")
    jobs.stream_status(stream, known, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    last = {r.item_id: (r.status, r.error_message) for r in queue.latest_status(spark.read.parquet(str(tmp_path / "out"))).collect()}
    assert last == {1: ("error", "boom"), 2: ("done", None)}


def test_scans_and_tactics(spark, tmp_path):
    def body(i):
        return json.dumps({"spi_score": i, "tactics": [{"code": f"F{j:02d}"} for j in range(i)]})

    batches = [[(f"h{i}", "v1.0", body(i)) for i in range(b * 3, b * 3 + 3)] for b in range(2)]
    stream = _land(spark, batches, "content_hash string, taxonomy_version string, body string", tmp_path / "in")
    for ck in ("ck1", "ck2"):
        jobs.stream_scans(stream, str(tmp_path / "out"), str(tmp_path / ck)).awaitTermination()
        assert spark.read.parquet(str(tmp_path / "out/scans")).count() == 6
        assert spark.read.parquet(str(tmp_path / "out/tactics")).count() == sum(range(6))
    raw = spark.read.parquet(str(tmp_path / "out/scans")).select(F.sum(F.size(response_tactics(F.parse_json("raw_output")))))
    assert raw.first()[0] == 15


def test_weekly_mart_follows_the_stream(spark, tmp_path):
    scans = spark.sql(
        """select id, concat('p', id % 3) as publisher_domain, 'n' as publisher_name, 'm' as media_class,
             if(id % 4 = 0, null, 'US') as region, 'c' as country, 'v' as taxonomy_version,
             cast(id % 50 as int) as spi_score, 'success' as scan_status, true as in_distribution,
             timestamp '2024-01-01 00:00:00' + make_dt_interval(cast(id % 25 as int)) as scanned_at
           from range(200)"""
    )
    path = tmp_path / "in"
    for b in range(3):
        scans.filter(F.col("id") % 3 == b).coalesce(1).write.mode("append").parquet(str(path))
        time.sleep(0.05)
    stream = spark.readStream.schema(scans.schema).option("maxFilesPerTrigger", 1).parquet(str(path))
    want = sorted(map(repr, (tuple(r) for r in marts.domain_integrity_weekly(scans).collect())))
    for ck in ("ck1", "ck2"):
        jobs.stream_weekly(stream, str(tmp_path / "store"), str(tmp_path / "mart"), str(tmp_path / ck), key="id").awaitTermination()
        mart = spark.read.parquet(str(tmp_path / "mart")).drop("week_start")
        assert sorted(map(repr, (tuple(r) for r in mart.collect()))) == want


def test_fifty_batches_cost_what_they_hold(spark, tmp_path):
    """Known texts are keyed state: each batch reads its own rows and touches its own keys, however long the history."""
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        rows = [[(f"h{b}-{i}" if i else "hot", "rss_article", b, 0, 0, i) for i in range(10)] for b in range(50)]
        stream = _land(spark, rows, CANDIDATE, tmp_path / "in")
        query = jobs.stream_candidates(stream, str(tmp_path / "out"), str(tmp_path / "ck"))
        query.awaitTermination()
        done = [p for p in query.recentProgress if p["numInputRows"]]
        assert len(done) == 50 and all(p["numInputRows"] == 10 for p in done)
        assert all(p["stateOperators"][0]["numRowsUpdated"] == 10 for p in done)
        assert done[-1]["stateOperators"][0]["numRowsTotal"] == 50 * 9 + 1
        got = spark.read.parquet(str(tmp_path / "out"))
        assert got.count() == 50 * 9 + 1 and got.where("content_hash = 'hot'").first()["fetched_at"] == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)


def test_new_checkpoint_leaves_history_alone(spark, tmp_path):
    """Batch ids begin at 0 again under a new checkpoint; what an earlier query wrote stays, and counts once."""
    columns = "scan_id string, publisher_domain string, publisher_name string, media_class string, region string, country string, taxonomy_version string, spi_score int, scan_status string, in_distribution boolean, scanned_at timestamp_ntz"
    from datetime import datetime

    day = lambda d: datetime(2024, 1, d)
    row = lambda i, score, d: (f"s{i}", "a.com", "A", "m", "US", "US", "v1", score, "success", True, day(d))
    store, mart = str(tmp_path / "store"), str(tmp_path / "mart")

    def run(name, batches, ck):
        jobs.stream_weekly(_land(spark, batches, columns, tmp_path / name), store, mart, str(tmp_path / ck)).awaitTermination()
        return {str(r.week)[:10]: (r.scan_count, r.avg_spi) for r in spark.read.parquet(mart).collect()}

    assert run("one", [[row(1, 10, 1), row(2, 20, 2)], [row(3, 30, 9)]], "ck1") == {"2024-01-01": (2, 15), "2024-01-08": (1, 30)}
    # another checkpoint, with a scan already counted and a new one of the same week
    assert run("two", [[row(1, 10, 1), row(4, 60, 3)]], "ck2") == {"2024-01-01": (3, 30), "2024-01-08": (1, 30)}
    # the first query goes on
    assert run("one", [[row(5, 50, 10)]], "ck1") == {"2024-01-01": (3, 30), "2024-01-08": (2, 40)}


def test_partials_are_folded_and_replayed(spark, tmp_path):
    from pressgauge.streaming import partials

    store, mart, schema = str(tmp_path / "store"), str(tmp_path / "mart"), "week timestamp, k string, n long"
    from datetime import datetime

    add = lambda df: df.groupBy("week", "k").agg(F.sum("n").alias("n"))

    def batch(query, number, *rows):
        partials.fold(spark.createDataFrame([(datetime(2024, 1, d), k, n) for d, k, n in rows], schema), store, mart, query, number, add, add, most=3)
        return {(r.week.day, r.k): r.n for r in spark.read.parquet(mart).collect()}

    for number in range(9):
        got = batch("q", number, (1, "a", 1), (8 if number % 2 else 15, "b", 10))
    assert got == {(1, "a"): 9, (8, "b"): 40, (15, "b"): 50}
    assert batch("q", 8, (1, "a", 1), (15, "b", 10)) == got  # the last batch again
    assert batch("p", 0, (1, "a", 100)) == {**got, (1, "a"): 109}  # a second query
    for number in range(1, 6):
        got = batch("p", number, (1, "a", 1))
    assert got[1, "a"] == 114 and batch("q", 8, (1, "a", 1), (15, "b", 10)) == got  # the first query's last batch, replayed late
    assert batch("q", 9, (8, "b", 1)) == {**got, (8, "b"): 41}
    assert len(list((tmp_path / "store").glob("base-*"))) == 1 and len(list((tmp_path / "store/deltas").iterdir())) <= 10


def test_status_machine(spark, tmp_path):
    from datetime import datetime

    at = lambda m: datetime(2024, 1, 1, 0, 0) if m is None else datetime(2024, 1, 1, m // 60, m % 60)
    good, bad = '{"spi_score": 5}', "null"
    claims = [[("ok", at(0)), ("twice", at(0)), ("stuck", at(0)), ("again", at(1)), ("bad", at(1))], [("twice", at(3)), ("late", at(300))], [("stuck", at(400))]]
    answers = [[("ok", at(2), good), ("bad", at(2), bad), ("unasked", at(2), good)], [("ok", at(4), good), ("again", at(5), good)], [("late", at(301), good)], [("stuck", at(401), good)]]
    asked = _land(spark, claims, "content_hash string, at timestamp", tmp_path / "claims")
    told = _land(spark, answers, "content_hash string, at timestamp, body string", tmp_path / "answers")
    jobs.stream_transitions(asked, told, str(tmp_path / "out"), str(tmp_path / "ck"), stuck_seconds=3600).awaitTermination()
    events, log = spark.read.parquet(str(tmp_path / "out/events")).collect(), {}
    for r in sorted(events, key=lambda r: r.step):
        log.setdefault(r.content_hash, []).append((r.step, r.status, r.error_message))
    assert log["ok"] == [(1, "processing", None), (2, "done", None)] == log["again"] == log["late"]
    assert log["bad"] == [(1, "processing", None), (2, "error", "response is null")]
    assert log["stuck"][:2] == [(1, "processing", None), (2, "pending", "no response in time")]
    assert log["stuck"][2:] == [(3, "processing", None), (4, "done", None)]  # it can be claimed again
    assert log["twice"][0] == (1, "processing", None) and "unasked" not in log
    refused = {(r.content_hash, r.rejected) for r in spark.read.parquet(str(tmp_path / "out/rejected")).collect()}
    assert refused == {("twice", "claim while processing"), ("unasked", "response while pending"), ("ok", "response while done")}


def test_tactic_mart_follows_the_stream(spark, tmp_path):
    scans = spark.sql(
        """select concat('s', id) as scan_id, 'success' as scan_status, id % 11 > 0 as in_distribution, if(id % 5 = 0, null, cast(id % 50 as int)) as spi_score,
             'US' as region, if(id % 2 = 0, 'x', 'y') as media_class, timestamp '2024-01-01 00:00:00' + make_dt_interval(0, cast(id * 6 as int)) as scanned_at from range(120)"""
    )
    tactics = spark.sql(
        """select concat('s', id) as scan_id, concat('T', id % 3) as tactic_code, 'l' as tactic_label, 'v' as taxonomy_version,
             timestamp '2024-01-01 00:00:00' + make_dt_interval(0, cast(id * 6 as int)) as detected_at from range(120) lateral view explode(sequence(1, 2)) t as n"""
    )
    for df, name, stamp in ((scans, "s", "scanned_at"), (tactics, "t", "detected_at")):
        for b in range(4):
            low, high = f"timestamp '2024-01-01 00:00:00' + make_dt_interval({b * 8})", f"timestamp '2024-01-01 00:00:00' + make_dt_interval({b * 8 + 8})"
            df.where(f"{stamp} >= {low} and {stamp} < {high}").coalesce(1).write.mode("append").parquet(str(tmp_path / name))
            time.sleep(0.05)
    read = lambda df, name: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))
    mart = str(tmp_path / "mart")
    jobs.stream_tactics(read(scans, "s"), read(tactics, "t"), str(tmp_path / "store"), mart, str(tmp_path / "ck")).awaitTermination()
    want = marts.tactic_frequency_weekly(tactics, scans)
    got = spark.read.parquet(mart).select(*want.columns)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect())) and got.count() > 10


def test_streamed_scans_of_another_checkpoint_are_not_repeated(spark, tmp_path):
    body = lambda i: json.dumps({"spi_score": i, "tactics": [{"code": "F01"}]})
    schema = "content_hash string, taxonomy_version string, body string"
    out = str(tmp_path / "out")
    jobs.stream_scans(_land(spark, [[("a", "v", body(1)), ("b", "v", body(2))]], schema, tmp_path / "one"), out, str(tmp_path / "ck1")).awaitTermination()
    jobs.stream_scans(_land(spark, [[("b", "v", body(2)), ("c", "v", body(3)), ("d", "v", "null")]], schema, tmp_path / "two"), out, str(tmp_path / "ck2")).awaitTermination()
    assert sorted(r.content_hash for r in spark.read.parquet(f"{out}/scans").collect()) == ["a", "b", "c"]
    assert sorted(r.scan_id for r in spark.read.parquet(f"{out}/tactics").collect()) == ["a", "b", "c"]


def test_status_machine_takes_rows_and_holds_one_timer_an_item():
    from types import SimpleNamespace

    from pyspark.sql import Row

    timers, kept = [], []
    item = SimpleNamespace(get=lambda: kept[-1] if kept else None, update=kept.append)
    handle = SimpleNamespace(getValueState=lambda *_: item, registerTimer=timers.append, deleteTimer=timers.remove)
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: 0)
    machine = jobs.status_machine(60)
    machine.init(handle)
    row = lambda second, kind, error=None: Row(micros=second * 1_000_000, kind=kind, error_message=error)
    told = [tuple(r) for r in machine.handleInputRows(("a",), iter([row(0, "claim")]), now)]
    assert told == [("a", 1, "processing", None, 0, None)] and timers == [60_000]
    told = [tuple(r) for r in machine.handleInputRows(("a",), iter([row(100, "response", "bad"), row(100, "claim")]), now)]
    assert told == [("a", 2, "pending", "no response in time", 60_000_000, None), ("a", 3, "processing", None, 100_000_000, None), ("a", 4, "error", "bad", 100_000_000, None)]
    assert timers == []
    kept[:] = [("processing", 1, 5, 5)]
    assert [tuple(r) for r in machine.handleExpiredTimer(("a",), now, None)] == [("a", 2, "pending", "no response in time", 5000, None)]
    assert kept[-1] == ("pending", 2, 5, None)
