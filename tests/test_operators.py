"""Dedup, suppression, enrichment, tactics, ads, queue and quality on small hand-made inputs."""

import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.tactics import tactic_vector
from pressgauge.operators import ads, content, dedup, enrich, quality, queue, tactic_rows
from pressgauge.plans import analyse, analytics, ingest, marts
from pressgauge.sinks import tables as sinks
from pressgauge.sources import seeds
from pressgauge.sources.responses import parse_responses

# --- dedup ------------------------------------------------------------------


@pytest.fixture(scope="module")
def hot(spark):
    """Candidates where one text makes up a third of all rows, with brute-force results."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        text = "hot" if i % 3 == 0 else f"t{rng.randrange(150)}"
        rows.append((text, rng.choice(["rss_article", "gdelt_article", "facebook_ad"]), rng.randrange(3), rng.randrange(4), rng.randrange(5), i))
    frame = spark.createDataFrame(
        rows, "content_hash string, source_type string, fetched_at int, phase int, feed_ordinal int, item_pos int"
    ).repartition(7)
    return rows, frame


def test_first_wins_is_total_order_minimum(hot):
    rows, frame = hot
    want = {}
    for r in sorted(rows, key=lambda r: r[2:]):
        want.setdefault(r[0], r)
    got = {tuple(r) for r in dedup.first_wins(frame, ["content_hash"], dedup.ORDER).collect()}
    assert got == set(want.values())


def test_first_wins_is_idempotent(hot):
    _, frame = hot
    once = dedup.first_wins(frame, ["content_hash"], dedup.ORDER)
    twice = dedup.first_wins(once, ["content_hash"], dedup.ORDER)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_suppression_and_reason_precedence(spark, hot):
    rows, frame = hot
    queued = spark.createDataFrame([(f"t{i}",) for i in range(0, 60)] * 2, "content_hash string")
    scanned = spark.createDataFrame([(f"t{i}",) for i in range(40, 90)] + [("hot",)], "content_hash string")
    q, s = {f"t{i}" for i in range(60)}, {f"t{i}" for i in range(40, 90)} | {"hot"}
    new, skipped = dedup.suppress_known(frame, queued, scanned)
    assert Counter(r.content_hash for r in new.collect()) == Counter(r[0] for r in rows if r[0] not in q | s)
    want = Counter((r[0], "queued" if r[0] in q else "scanned") for r in rows if r[0] in q | s)
    assert Counter((r.content_hash, r.reason) for r in skipped.collect()) == want


def test_run_outcomes_replay_the_sequential_loop(spark, hot):
    rows, frame = hot
    queued_rows = [(f"t{i}",) for i in range(0, 60)]
    scanned_rows = [(f"t{i}",) for i in range(40, 90)]
    in_queue, in_scans = {r[0] for r in queued_rows}, {r[0] for r in scanned_rows}
    want = Counter()
    for r in sorted(rows, key=lambda r: r[2:]):
        if r[0] in in_queue:
            want[(r[1], "skipped", "queued")] += 1
        elif r[0] in in_scans:
            want[(r[1], "skipped", "scanned")] += 1
        else:
            in_queue.add(r[0])
            want[(r[1], "queued", None)] += 1
    got = dedup.run_outcomes(
        frame,
        spark.createDataFrame(queued_rows, "content_hash string"),
        spark.createDataFrame(scanned_rows, "content_hash string"),
    )
    assert {(r.source_type, r.outcome, r.skip_reason): r["items"] for r in got.collect()} == dict(want)


def test_discovery_only_in_the_first_batch(spark):
    a = spark.createDataFrame([("f",)], "article_url string")
    b = spark.createDataFrame([("d",)], "article_url string")
    assert ingest.collect_run(a, b, start=0).count() == 2
    assert ingest.collect_run(a, b, start=10).count() == 1


def test_theme_needs_its_required_word(spark):
    docs = spark.createDataFrame(
        [(1, "The VACCINE rollout"), (2, "covid and Misinformation"), (3, "Fake News"), (4, "voter fraud; propaganda"), (5, "none")],
        "doc_id int, body_text string",
    )
    got = {(r.doc_id, r.theme) for r in content.theme_matches(docs).collect()}
    assert got == {(2, "Health Disinfo"), (2, "Disinfo"), (3, "Disinfo"), (4, "Election"), (4, "Manipulation")}


# --- enrichment ----------------------------------------------------------------


@pytest.fixture(scope="module")
def dimension(spark):
    return spark.createDataFrame(
        [("a.example", None, "High", "HIGH"), ("b.example", "Left", "Low", "LOW")],
        "domain string, mbfc_bias string, mbfc_factuality string, mbfc_credibility string",
    )


def test_lookup_never_mixes_two_hits(spark, dimension):
    items = spark.createDataFrame(
        [(1, "www.A.example", "b.example"), (2, "none.example", "WWW.b.example"), (3, "x", None), (4, None, "a.example")],
        "id int, article_domain string, publisher_domain string",
    )
    got = {r.id: (r.mbfc_bias, r.mbfc_factuality, r.mbfc_credibility) for r in enrich.credibility_lookup(items, dimension).collect()}
    assert got == {1: (None, "High", "HIGH"), 2: ("Left", "Low", "LOW"), 3: (None, None, None), 4: (None, "High", "HIGH")}
    exact = enrich.credibility_lookup(items, dimension, mode="exact")
    assert [r.mbfc_factuality for r in exact.orderBy("id").collect()] == [None] * 4


def test_upsert_replaces_whole_rows(spark, dimension):
    new = spark.createDataFrame(
        [("b.example", "Right", None, "MIXED"), ("c.example", None, None, "MIXED")], dimension.schema
    )
    got = {tuple(r) for r in enrich.upsert_snapshot(dimension, new, "domain").collect()}
    assert got == {
        ("a.example", None, "High", "HIGH"),
        ("b.example", "Right", None, "MIXED"),
        ("c.example", None, None, "MIXED"),
    }


def test_snapshot_versions(spark, dimension, tmp_path):
    sinks.write_snapshot(dimension, str(tmp_path), "1")
    sinks.write_snapshot(dimension.limit(1), str(tmp_path), "2")
    assert Counter(r.version for r in spark.read.parquet(str(tmp_path)).collect()) == {1: 2, 2: 1}


# --- tactics -------------------------------------------------------------------


@pytest.fixture(scope="module")
def parsed(spark):
    bodies = {
        "missing": {"spi_score": 5},
        "empty": {"tactics": []},
        "scalar": {"tactics": "none", "spi_score": None},
        "mixed": {
            "spi_score": 70,
            "the_play": "",
            "tactics": [
                {"code": "F01", "label": "L", "name": "N", "severity": "critical", "evidence": "e"},
                {"name": "N", "severity": "odd", "excerpt": "x"},
                {"tactic_code": "T9", "severity": "note"},
                {"code": "", "label": "", "severity": "warning", "evidence": ""},
                "bare",
            ],
        },
    }
    rows = [(k, "v1.0", json.dumps(b)) for k, b in bodies.items()] + [("broken", "v1.0", "oops {")]
    return parse_responses(spark.createDataFrame(rows, "content_hash string, taxonomy_version string, body string"))


def test_response_fields(parsed):
    got = {r.content_hash: (r.spi_score, r.the_play, r.raw_output is not None) for r in parsed.collect()}
    assert got == {
        "missing": (5, None, True),
        "empty": (None, None, True),
        "scalar": (None, None, True),
        "mixed": (70, "", True),
        "broken": (None, None, True),
    }


def test_vector(parsed):
    got = {r[0]: r[1] for r in parsed.select("content_hash", tactic_vector(F.col("tactics"))).collect()}
    assert {k: v for k, v in got.items() if v is None}.keys() == {"missing", "empty", "scalar", "broken"}
    assert [tuple(e) for e in got["mixed"]] == [("N", 3), ("N", 1), ("T9", 1), ("unknown", 2), ("unknown", 1)]


def test_rows_of_both_dialects(parsed):
    rows = sorted(tactic_rows.flatten_tactics(parsed).collect(), key=lambda r: r.tactic_pos)
    assert [(r.tactic_code, r.tactic_label, r.severity, r.evidence_excerpt) for r in rows] == [
        ("F01", "L", "critical", "e"),
        (None, "N", "odd", "x"),
        (None, None, "note", None),
        ("", "", "warning", ""),
        (None, None, None, None),
    ]
    rows = sorted(tactic_rows.flatten_tactics(parsed, "v1").collect(), key=lambda r: r.tactic_pos)
    assert [(r.tactic_code, r.severity, r.evidence_excerpt, r.taxonomy_version) for r in rows] == [
        ("F01", "critical", "e", "1.0"),
        (None, "odd", None, "1.0"),
        (None, "note", None, "1.0"),
        (None, "warning", None, "1.0"),
        (None, None, None, "1.0"),
    ]
    assert [r.tactic_label for r in rows[:2]] + [rows[4].tactic_label] == ["L", "N", "bare"]
    assert json.loads(rows[2].tactic_label) == {"tactic_code": "T9", "severity": "note"}


def test_row_count_is_sum_of_array_sizes(parsed):
    total = parsed.select(F.sum(F.greatest(F.size("tactics"), F.lit(0)))).first()[0]
    assert tactic_rows.flatten_tactics(parsed).count() == total == 5


def test_code_mismatch(parsed):
    assert tuple(quality.code_mismatch(parsed).first()) == (5, 5)


def test_provenance(spark):
    rows = [("rss_article", "a.example"), ("gdelt_article", "b.example"), ("facebook_ad", "c")]
    df = spark.createDataFrame(
        [(*r, "adv", "term", "US") for r in rows],
        "source_type string, article_domain string, advertiser_name string, search_term string, ad_country string",
    )
    got = {r.source_type: (r.scan_source, r.gdelt_source, r.article_domain, r.analysis_scope, r.advertiser_name) for r in content.with_provenance(df).collect()}
    assert got == {
        "rss_article": ("crawler", False, "a.example", None, None),
        "gdelt_article": ("crawler", True, "b.example", None, None),
        "facebook_ad": ("facebook_ad_scraper", False, "facebook.com", "copy_only", "adv"),
    }


# --- ads --------------------------------------------------------------------------

LONG = "a text of more than twenty characters"


RUN = "timestamp '2024-01-01 00:00:00'"


def _in_run(df, run=RUN):
    return df.withColumn("fetched_at", F.expr(run))


def _nodes(spark, rows, run=RUN):
    return _in_run(
        spark.createDataFrame(
            rows, "term string, country string, container_pos long, node_pos long, text string, advertiser_name string"
        ),
        run,
    )


def test_card_assembly(spark):
    nodes = _nodes(
        spark,
        [
            ("t", "US", 1, 2, LONG + " two", "Acme"),
            ("t", "US", 1, 1, "  " + LONG + " one ", "Acme"),
            ("t", "US", 1, 3, "12:30 " + LONG, "Acme"),
            ("t", "US", 1, 4, LONG + " Sponsored", "Acme"),
            ("t", "US", 1, 5, "exactly twenty chars", "Acme"),
            ("t", "US", 2, 1, LONG, " "),
            *[("t", "GB", i, 1, f"{LONG} {LONG} {i}", None) for i in range(7)],
        ],
    )
    cards = {(r.country, r.container_pos): (r.ad_text, r.advertiser_name) for r in ads.assemble_ads(nodes).collect()}
    assert cards[("US", 1)] == (f"{LONG} one {LONG} two", "Acme")
    assert ("US", 2) not in cards  # 37 characters
    assert sorted(p for c, p in cards if c == "GB") == [0, 1, 2, 3, 4]
    assert cards[("GB", 0)][1] == ads.UNKNOWN_ADVERTISER


def test_giant_card_keeps_document_order(spark):
    rng = random.Random(3)
    order = list(range(2000))
    rng.shuffle(order)
    nodes = _nodes(spark, [("t", "US", 1, i, f"node number {i:06d} of the card", None) for i in order])
    text = ads.assemble_ads(nodes.repartition(5)).first().ad_text
    assert text == " ".join(f"node number {i:06d} of the card" for i in range(2000))


def test_runs_keep_their_own_cards_and_cuts(spark):
    runs = [f"timestamp '2024-01-0{day} 00:00:00'" for day in (1, 2, 3)]
    rows = [(C.AD_TERMS[0][0], "US", i, 1, f"{LONG} {LONG} {i}", None) for i in range(6)]
    nodes = _nodes(spark, rows, runs[0]).union(_nodes(spark, rows, runs[1])).union(_nodes(spark, rows, runs[2]))
    cards = ads.assemble_ads(nodes).collect()
    assert len(cards) == 15 and {r.ad_text for r in cards} == {f"{LONG} {LONG} {i}" for i in range(5)}
    kept = ads.ads_per_term(ads.assemble_ads(nodes), seeds.search_terms(spark))
    assert Counter((r.fetched_at.day, r.term_pos) for r in kept.collect()) == {(d, p): 1 for d in (1, 2, 3) for p in range(1, 6)}


def test_failed_responses_give_events_and_no_scan(spark):
    bodies = {"good": '{"spi_score": 72}', "text": '{"spi_score": "70"}', "half": '{"spi_score": 72.5}', "down": "upstream error", "none": "{}"}
    rows = spark.createDataFrame(list(bodies.items()), "content_hash string, body string")
    got = {r.content_hash: (r.spi_score, r.error_message) for r in parse_responses(rows).collect()}
    assert got == {"good": (72, None), "text": (70, None), "half": (None, "spi_score is not an integer"), "down": (None, "response is not JSON"), "none": (None, None)}
    items = spark.createDataFrame([(k, "rss_article", "a.com", "a.com", "n", None, None, None) for k in bodies], "content_hash string, source_type string, article_domain string, publisher_domain string, publisher_name string, advertiser_name string, search_term string, ad_country string")
    dimension = spark.createDataFrame([], "domain string, mbfc_bias string, mbfc_factuality string, mbfc_credibility string")
    scans = analyse.scans_from_responses(items, rows, dimension)
    assert {r.content_hash for r in scans.filter("scanned_at is not null").collect()} == {"good", "text", "none"}
    events = analyse.status_events(rows).orderBy("content_hash", "step").collect()
    assert [(r.status, r.error_message) for r in events if r.content_hash == "down"] == [("processing", None), ("error", "response is not JSON")]
    assert Counter(r.status for r in events) == {"processing": 5, "done": 3, "error": 2}


def test_pages_belong_to_their_run(spark):
    day = "timestamp '2024-01-0{} 00:00:00'"
    items = _in_run(spark.createDataFrame([("u",)], "article_url string"), day.format(1)).union(_in_run(spark.createDataFrame([("u",)], "article_url string"), day.format(2)))
    pages = [_in_run(spark.createDataFrame([("u", f"<p>{n} " + "word " * 60)], "url string, html string"), day.format(n)) for n in (1, 2)]
    got = ingest.with_page_text(items, pages[0].union(pages[1])).collect()
    assert sorted((r.fetched_at.day, r.body_text[:1]) for r in got) == [(1, "1"), (2, "2")]


def test_older_scans_get_the_column_defaults(spark):
    old = spark.createDataFrame([("h", "a.com", "T")], "content_hash string, article_domain string, article_title string")
    row = content.canonicalise_v1(old).first()
    assert (row.in_distribution, row.language, row.scan_status, row.truncated) == (True, "en", "success", False)
    assert content.canonicalise_v1(old.withColumn("in_distribution", F.lit(False))).first().in_distribution is False


def test_fallback_only_for_pages_without_cards(spark):
    block = "x" * 50
    blocks = spark.createDataFrame(
        [("t", "US", 1, block), ("t", "GB", 1, "x" * 49), ("t", "GB", 2, block + " Log in"), ("t", "GB", 3, "Facebook " + block), ("t", "GB", 4, f" {block} ")],
        "term string, country string, container_pos long, text string",
    )
    primary = _in_run(spark.createDataFrame([("t", "US")], "term string, country string"))
    got = ads.fallback_ads(_in_run(blocks), primary).collect()
    assert [(r.country, r.container_pos, r.ad_text) for r in got] == [("GB", 4, block)]


def test_first_country_fills_the_term(spark):
    term = C.AD_TERMS[0][0]
    rows = [(term, "US", i, f"us {i}", "A") for i in range(4)] + [(term, "GB", i, f"gb {i}", "A") for i in range(4)]
    frame = spark.createDataFrame(rows, "term string, country string, container_pos long, ad_text string, advertiser_name string")
    kept = ads.ads_per_term(_in_run(frame), seeds.search_terms(spark))
    assert Counter(r.country for r in kept.collect()) == {"US": 4, "GB": 1}
    row = ads.ad_candidates(kept.filter("country = 'GB'")).first()
    assert (row.region, row.country, row.article_domain, row.headline_text, row.search_term) == (
        "UK", "United Kingdom", "facebook.com", "gb 0", term,
    )
    assert "q=weight%20loss%20supplement&" in row.article_url
    queued = ingest.with_queue_constants(ads.ad_candidates(kept)).first()
    assert (queued.queued_at, queued.status, queued.taxonomy_version) == (None, "pending", C.TAXONOMY_VERSION)


# --- queue -------------------------------------------------------------------------


def test_queue_log(spark):
    items = spark.sql(
        """select * from values (1, 'h1', 'pending', timestamp '2024-01-02 00:00:00'), (2, 'h2', 'pending', null),
           (3, 'h3', 'pending', timestamp '2024-01-01 00:00:00'), (4, 'h4', 'pending', timestamp '2024-01-01 00:00:00')
           as t(item_id, content_hash, status, queued_at)"""
    )
    events = spark.sql(
        """select * from values (1, 1, 'processing', timestamp '2024-01-03 00:00:00', null),
           (1, 2, 'error', timestamp '2024-01-03 00:01:00', 'boom'), (4, 3, 'done', timestamp '2024-01-03 00:02:00', null),
           (4, 1, 'processing', timestamp '2024-01-03 00:00:00', null) as t(item_id, seq, status, processed_at, error_message)"""
    )
    last = {r.item_id: (r.status, r.error_message) for r in queue.latest_status(events).collect()}
    assert last == {1: ("error", "boom"), 4: ("done", None)}
    current = queue.current_queue(items, events)
    assert queue.queue_depth(current).first()[0] == 2
    assert [r.item_id for r in queue.claim_batch(current, 80).collect()] == [3, 2]
    assert [r.item_id for r in queue.claim_batch(current, 1).collect()] == [3]
    summary = queue.analysis_summary(current.filter("item_id in (1, 4)"), current).first()
    assert tuple(summary) == (2, 1, 1, 0.006, 2)


# --- marts and analytics --------------------------------------------------------------


@pytest.fixture(scope="module")
def facts(spark):
    scans = spark.sql(
        """select *, 'n' as publisher_name, 'm' as media_class, 'c' as country, 'v' as taxonomy_version from values
        ('a', 'p', 'US', 10, 'success', true, timestamp '2024-03-03 23:59:00'),
        ('b', 'p', 'US', 13, 'success', true, timestamp '2024-03-04 00:00:00'),
        ('c', 'p', 'US', null, 'success', true, timestamp '2024-03-04 01:00:00'),
        ('d', 'p', 'US', 90, 'analysis_error', true, timestamp '2024-03-04 01:00:00'),
        ('e', 'p', 'US', 90, 'success', null, timestamp '2024-03-04 01:00:00'),
        ('f', 'p', null, 40, 'success', true, timestamp '2024-12-30 01:00:00')
        as t(scan_id, publisher_domain, region, spi_score, scan_status, in_distribution, scanned_at)"""
    )
    tactics = spark.sql(
        """select *, 'x' as tactic_label, 'v' as taxonomy_version from values
        ('a', 'F01'), ('b', 'F01'), ('b', 'F01'), ('c', 'F01'), ('d', 'F01'), ('f', 'F01'), ('f', 'M02'), ('zz', 'M02')
        as t(scan_id, tactic_code)"""
    )
    return tactics, scans


def test_domain_mart(facts):
    _, scans = facts
    mart = marts.domain_integrity_weekly(scans, ordered=True).collect()
    assert [(str(r.week)[:10], r.region, r.scan_count, r.avg_spi) for r in mart] == [
        ("2024-12-30", None, 1, 40), ("2024-03-04", "US", 1, 13), ("2024-02-26", "US", 1, 10),
    ]
    assert sum(r.scan_count for r in mart) == marts.benchmarkable(scans).count()


def test_tactic_mart_is_weighted_by_rows(facts):
    mart = {(r.tactic_code, str(r.week)[:10]): (r.occurrences, r.avg_spi_when_present) for r in marts.tactic_frequency_weekly(*facts).collect()}
    assert mart == {
        ("F01", "2024-02-26"): (1, 10),
        ("F01", "2024-03-04"): (3, 13),
        ("F01", "2024-12-30"): (1, 40),
        ("M02", "2024-12-30"): (1, 40),
    }


def test_emerging_fills_quiet_quarters(facts):
    got = [(r.tactic_code, str(r.quarter)[:7], r.occurrences, r.change, r.first_seen) for r in analytics.emerging_tactics(*facts).orderBy("tactic_code", "quarter").collect()]
    assert got == [
        ("F01", "2024-01", 4, None, True),
        ("F01", "2024-04", 0, -4, False),
        ("F01", "2024-07", 0, 0, False),
        ("F01", "2024-10", 1, 1, False),
        ("M02", "2024-10", 1, None, True),
    ]


def test_correlation_equals_its_definition(facts):
    got = {r.tactic_code: r.corr_spi for r in analytics.tactic_spi_corr(*facts).collect()}
    y = {"a": 10.0, "b": 13.0, "f": 40.0}
    x = {"a": 0.0, "b": 0.0, "f": 1.0}
    n = len(y)
    mx, my = sum(x.values()) / n, sum(y.values()) / n
    cov = sum((x[k] - mx) * (y[k] - my) for k in y)
    sd = (sum((v - mx) ** 2 for v in x.values()) * sum((v - my) ** 2 for v in y.values())) ** 0.5
    assert got["F01"] is None  # shown by every scored scan
    assert got["M02"] == round(cov / sd, 6)


def test_quality(facts, spark):
    tactics, scans = facts
    assert [r.scan_id for r in quality.orphans(tactics, scans, "scan_id").collect()] == ["zz"]
    assert quality.cascade(tactics, scans, "scan_id").count() == 7
    patterns = spark.createDataFrame([("F01",), ("F01",)], "pattern_id string")
    assert [tuple(r) for r in quality.unknown_codes(tactics, patterns).collect()] == [("M02", 2)]
    report = quality.constraint_report(scans, not_null=["spi_score"], accepted={"region": ("US",)}, unique=["scan_id", "publisher_domain"])
    assert {r.rule: r.violations for r in report.collect()} == {
        "spi_score not null": 1, "region accepted": 0, "scan_id unique": 0, "publisher_domain unique": 1,
    }


def test_mart_refresh_touches_only_its_weeks(facts, spark, tmp_path):
    _, scans = facts
    path = str(tmp_path / "mart")
    sinks.refresh_mart(marts.domain_integrity_weekly(scans), path)
    again = scans.filter("scan_id = 'b'").withColumn("spi_score", F.lit(99))
    sinks.refresh_mart(marts.domain_integrity_weekly(again), path)
    got = {(str(r.week)[:10], r.avg_spi) for r in spark.read.parquet(path).collect()}
    assert got == {("2024-02-26", 10), ("2024-03-04", 99), ("2024-12-30", 40)}


def test_queue_sink_is_repeatable(spark, tmp_path):
    rows = spark.sql("select 'h' as content_hash, timestamp '2024-01-01 10:00:00' as fetched_at")
    for run in ("1", "1", "2"):
        sinks.append_candidates(rows, str(tmp_path), run)
    assert spark.read.parquet(str(tmp_path)).count() == 2


def test_scores_that_no_integer_column_holds_end_as_one_error(spark):
    bodies = {
        "big": '{"spi_score": 1e12}', "word": '{"spi_score": "abc"}', "null": "null", "none": '{"spi_score": null}', "truth": '{"spi_score": true}',
        "list": '{"spi_score": [1]}', "object": '{"spi_score": {}}', "blank": '{"spi_score": ""}', "edge": '{"spi_score": 2147483647}', "past": '{"spi_score": 2147483648}',
        "low": '{"spi_score": -3}', "round": '{"spi_score": 7.0}', "bare": '"text"',
    }
    rows = spark.createDataFrame(list(bodies.items()), "content_hash string, body string")
    got = {r.content_hash: (r.spi_score, r.error_message) for r in parse_responses(rows).collect()}
    unfit, fine = "spi_score is not an integer", {"none": None, "edge": 2147483647, "low": -3, "round": 7, "bare": None}
    assert got == {**{k: (None, unfit) for k in ("big", "word", "truth", "list", "object", "blank", "past")}, "null": (None, "response is null"), **{k: (v, None) for k, v in fine.items()}}
    events = analyse.status_events(rows).where("step = 2").collect()
    assert {r.content_hash for r in events if r.status == "error"} == set(bodies) - set(fine)
