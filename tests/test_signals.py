"""Corpus signals on small hand-made inputs; the queries compare whole tables with SQL."""

from pyspark.sql import functions as F

from pressgauge.plans import signals


def test_bursts_need_history_and_spread(spark):
    rows = [("a", h, 10 + h % 2) for h in range(10)] + [("a", 10, 60), ("b", 0, 500), ("b", 1, 5)]
    events = spark.createDataFrame(rows, "event_type string, h int, n int").select(
        "event_type", (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("h"))).alias("ts"), F.explode(F.sequence(F.lit(1), F.col("n")))
    )
    assert [(r.grp, r.hour.hour, r.n) for r in signals.volume_bursts(events).collect()] == [("a", 10, 60)]


def test_silent_hours_lower_the_mean(spark):
    """Ten events every sixth hour: the silent hours between are part of the history."""
    rows = [(6 * i, 10) for i in range(6)] + [(37, 10)]
    events = spark.createDataFrame(rows, "h int, n int").select(
        F.lit("a").alias("event_type"), (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=F.col("h"))).alias("ts"), F.explode(F.sequence(F.lit(1), F.col("n")))
    )
    got = {r.hour.day * 24 + r.hour.hour - 24: r.z for r in signals.volume_bursts(events).collect()}
    counts = dict(rows)
    for hour, n in rows:
        history = [counts.get(h, 0) for h in range(max(0, hour - 24), hour)]
        if len(history) >= 3 and len(set(history)) > 1:
            mean = sum(history) / len(history)
            z = (n - mean) / (sum((x - mean) ** 2 for x in history) / len(history)) ** 0.5
            assert (round(z, 6) == got[hour]) if z >= 2 else hour not in got
    assert set(got) <= set(counts) and len(got) > 3


def test_cycles_and_own_links(spark):
    pages = [("https://a.com/1", "<a href='https://b.com/x'>"), ("https://b.com/", '<a href="http://www.a.com">'), ("https://c.com", '<a href="https://a.com"><a href="https://c.com/2">'), ("https://d.com", None)]
    edges = signals.link_edges(spark.createDataFrame(pages, "url string, html string"))
    assert {tuple(r) for r in edges.collect()} == {("a.com", "b.com"), ("b.com", "a.com"), ("c.com", "a.com")}
    assert [tuple(r) for r in signals.citation_cycles(edges).collect()] == [("a.com", "b.com")]


def test_text_signals(spark):
    docs = spark.createDataFrame([(1, "x y z x y z"), (2, "x"), (3, None), (4, "A line\nof the of the")], "doc_id long, text string")
    assert {r.doc_id: (r.grams, r.ratio) for r in signals.repetition_ratio(docs).collect()} == {1: (4, 0.25), 2: (0, 0.0), 3: (0, 0.0), 4: (4, 0.0)}
    assert [(r.doc_id, r.cue, r.hits, r.per_1000) for r in signals.cue_hits(docs, ("OF the",)).collect()] == [(4, "OF the", 2, 333.333333)]
    heads = spark.createDataFrame([(1, "Big News now", "the news is big"), (2, "...", "x"), (3, None, None)], "doc_id long, h string, b string")
    assert {r.doc_id: r.overlap for r in signals.headline_overlap(heads, "h", "b").collect()} == {1: 0.666667, 2: None, 3: None}
    shared = spark.createDataFrame([(i, f"footer\nown {i}") for i in range(3)], "doc_id long, text string")
    assert {r.share for r in signals.template_share(shared).collect()} == {0.5}


def test_void_and_trail(spark):
    pages = spark.createDataFrame([(1, '<meta name="author" content="x">'), (2, "<p>"), (3, None), (4, "<TIME>")], "page_id long, html string")
    assert {r.page_id: r.void for r in signals.provenance_void(pages).collect()} == {1: False, 2: True, 3: True, 4: False}
    scans = spark.sql("select * from values ('h', 'fringe', 1), ('h', 'main', 5), ('h', 'main', 3), ('g', 'main', 1), ('h', null, 0) as t(content_hash, media_class, scanned_at)")
    assert sorted((r.media_class, r.first_seen, r.step) for r in signals.migration_trail(scans).collect()) == [("fringe", 1, 1), ("main", 3, 2)]
