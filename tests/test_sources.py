"""Feed dialects, discovery lists, credibility corpora, seeds and pattern definitions."""

import json

import pytest
from pyspark.sql import functions as F

from pressgauge.operators.dedup import first_wins
from pressgauge.sources import discovery, enrichment, feeds, seeds, taxonomy

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>c</title><link>http://c</link>
<item><title>One &amp; two</title><link>http://a/1</link><pubDate>Mon, 01 Jan 2024 06:00:00 GMT</pubDate></item>
<item><title>No link</title><link></link></item>
<item><link>http://a/3</link></item>
<item><title>Four</title><link>http://a/4</link></item></channel></rss>"""
SINGLE = "<rss><channel><item><title>only</title><link>http://a/9</link></item></channel></rss>"
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>t</title><link href="http://self"/>
<entry><title type="html">X</title><link rel="self" href="http://s/1"/><link rel="alternate" href="http://a/2"/>
<updated>2024-01-02T00:00:00Z</updated></entry></feed>"""
RDF = """<rdf:RDF xmlns:rdf="r" xmlns="p" xmlns:dc="d"><channel><title>q</title><link>http://c</link></channel>
<item><title>Z</title><link>http://r/1</link><dc:date>2024-01-01</dc:date></item></rdf:RDF>"""


@pytest.fixture
def items(spark):
    rows = [(n, "2024-01-01", b) for n, b in (("rss", RSS), ("one", SINGLE), ("atom", ATOM), ("rdf", RDF), ("junk", "no xml"))]
    return feeds.parse_feeds(spark.createDataFrame(rows, "feed_url string, fetched_at string, body string"))


def test_dialects(items):
    got = {(r.feed_url, r.pos): (r.title, r.url, r.published_raw) for r in items.collect()}
    assert got == {
        ("rss", 1): ("One & two", "http://a/1", "Mon, 01 Jan 2024 06:00:00 GMT"),
        ("rss", 2): ("No link", "", None),
        ("rss", 3): ("", "http://a/3", None),
        ("rss", 4): ("Four", "http://a/4", None),
        ("one", 1): ("only", "http://a/9", None),
        ("atom", 1): ("X", "http://a/2", "2024-01-02T00:00:00Z"),
        ("rdf", 1): ("Z", "http://r/1", None),
    }


def test_cut_comes_before_the_url_filter(items):
    kept = feeds.first_items(items, 3).filter("feed_url = 'rss'")
    assert sorted(r.pos for r in kept.collect()) == [1, 3]


def test_slicing_before_the_explode_is_the_same(spark, items):
    rows = [("rss", "2024-01-01", RSS)]
    cut = feeds.parse_feeds(spark.createDataFrame(rows, "feed_url string, fetched_at string, body string"), 3)
    assert feeds.first_items(cut).count() == feeds.first_items(items.filter("feed_url = 'rss'")).count() == 2


def test_discovery(spark):
    body = json.dumps(
        {
            "articles": [
                {"url": "https://www.a.example/1", "domain": "", "title": None, "seendate": "20240101T000000Z", "tone": -1.5, "language": "Russian"},
                {"url": "", "domain": "b.example"},
                {"url": "nothing", "domain": "b.example"},
                {"url": "https://c.example/1", "domain": "listed.example", "title": "T", "tone": "2.5", "language": "English"},
                {"url": "https://d.example/1", "tone": 3},
            ]
        }
    )
    payloads = spark.createDataFrame(
        [(0, "Election", "t", body), (1, "Disinfo", "t", "not json")],
        "theme_ordinal int, theme string, fetched_at string, body string",
    )
    valid = discovery.valid_discovery(discovery.parse_discovery(payloads))
    v1 = {r.article_domain: (r.country, r.gdelt_tone) for r in discovery.v1_discovery_fields(valid).collect()}
    assert v1 == {"a.example": ("RU", -1.5), "c.example": (None, None), "d.example": (None, 3.0)}
    names = {r.article_domain: (r.publisher_name, r.headline_text) for r in discovery.discovery_candidates(valid).collect()}
    assert names == {"a.example": ("a.example", ""), "c.example": ("listed.example", "T"), "d.example": ("d.example", "")}


def test_enrichment_first_record_wins(spark, tmp_path):
    (tmp_path / "corpus.json").write_text(
        json.dumps(
            [
                {"source_url_normalized": "a.example", "bias": "left", "factual_reporting": "HIGH"},
                {"source_url_normalized": "", "url": "https://www.A.example/x", "bias": "right", "country": ""},
                {"bias": "left"},
                {"domain": "b.example", "bias": "Conspiracy-Pseudoscience", "factual_reporting": "high", "country": "UK"},
            ],
            indent=1,
        )
    )
    records = enrichment.parse_enrichment(enrichment.read_enrichment_files(spark, str(tmp_path)))
    dim = first_wins(enrichment.normalise_enrichment(records), ["domain"], ["payload_no", "pos"])
    got = {r.domain: (r.mbfc_bias, r.mbfc_factuality, r.mbfc_country, r.mbfc_credibility) for r in dim.collect()}
    assert got == {
        "a.example": ("Left", "High", None, "HIGH"),
        "b.example": ("Conspiracy-Pseudoscience", "High", "UK", "DISPUTED"),
    }


def test_seeds(spark):
    assert seeds.feeds(spark).count() == 20
    assert seeds.feeds(spark, legacy=True).count() == 23
    assert seeds.themes(spark).count() == 4
    grid = seeds.search_terms(spark)
    assert grid.count() == 28
    first = grid.orderBy("term_ordinal", "country_ordinal").limit(2).collect()
    assert [(r.term, r.country) for r in first] == [("weight loss supplement", "US"), ("weight loss supplement", "GB")]
    assert [r.ordinal for r in seeds.feed_slice(seeds.feeds(spark), 18, 999).collect()] == [18, 19]
    assert seeds.feeds(spark).filter(F.col("name").contains("'")).count() == 1


DOC = """# Title
# SECTION A: FIRST
## A1: ONE

F01 | Plain pattern
Says a thing.

M35 | Tagged pattern (Layer 2/4: Origin)
Says more. Enhanced by Layer 3: "Shown Name" — details. Detection: look for marks.

# SECTION D: SECOND
R01 | Other pattern
Text.
# Shown Name      → M35                → Layer 2/4
# Other Shown     → F01 (enhanced)     → Layer 3
"""


def test_taxonomy_document(spark, tmp_path):
    (tmp_path / "patterns.md").write_text(DOC)
    lines = taxonomy.read_taxonomy(spark, str(tmp_path / "patterns.md"))
    patterns = taxonomy.parse_patterns(lines)
    got = {r.pattern_id: (r.prefix, r.name, r.section, r.subsection) for r in patterns.collect()}
    assert got == {
        "F01": ("F", "Plain pattern", "FIRST", "A1: ONE"),
        "M35": ("M", "Tagged pattern (Layer 2/4: Origin)", "FIRST", "A1: ONE"),
        "R01": ("R", "Other pattern", "SECOND", "A1: ONE"),
    }
    attrs = {r.pattern_id: (r.detection, r.enhanced_layer, r.enhanced_name, r.name_layer) for r in taxonomy.pattern_attrs(patterns).collect()}
    assert attrs["M35"] == ("look for marks.", 3, "Shown Name", "2/4")
    assert attrs["F01"] == (None, None, None, None)
    names = {(r.pattern_id, r.display_name, r.enhanced, r.source_layer) for r in taxonomy.display_names(lines).collect()}
    assert names == {("M35", "Shown Name", False, "2/4"), ("F01", "Other Shown", True, "3")}


def test_audience_ranges(spark):
    routed = taxonomy.audience_routing(spark)
    by = {a: {r.pattern_id for r in routed.filter(F.col("audience") == a).collect()} for a in ("consumer", "regulatory trigger", "procurement")}
    assert by == {
        "consumer": {"A16", "A17", "A20"},
        "regulatory trigger": {"C03", "C04", "C06", "C09", "C10", "C14", "C21", "C22"},
        "procurement": {"A14", "A15", "A19", "O08", "O09", "O10", "O11"},
    }


def test_malformed_payloads_are_counted_beside_the_write(spark, tmp_path):
    from pressgauge.plans import counters

    good = "<rss><channel><item><title>a</title><link>http://a</link></item><item><link>http://b</link></item></channel></rss>"
    bodies = [good, "<rss><channel></channel></rss>", good[:60], "plain text", "", None]
    feeds = spark.createDataFrame([(f"u{i}", i, b) for i, b in enumerate(bodies)], "feed_url string, fetched_at int, body string")
    lists = ['{"articles":[{"url":"http://x"}]}', '{"articles":[]}', "{}", '{"articles":[{"url"', "", None]
    found = spark.createDataFrame([(0, "t", i, b) for i, b in enumerate(lists)], "theme_ordinal int, theme string, fetched_at int, body string")
    parts = {"feeds": counters.counted_feeds(feeds), "lists": counters.counted_lists(found)}
    counters.write_counted(parts, str(tmp_path), "r1")
    got = {(r.part, r.counter): r.value for r in spark.read.parquet(str(tmp_path / "counters")).collect()}
    assert got == {
        ("feeds", "payloads"): 6, ("feeds", "errors"): 4, ("feeds", "found"): 2,
        ("lists", "payloads"): 6, ("lists", "errors"): 3, ("lists", "found"): 1,
    }
    assert spark.read.parquet(str(tmp_path / "feeds")).count() == 2
    recount = feeds.where(counters.malformed_feed(feeds.body)).count(), found.where(counters.malformed_list(found.body)).count()
    assert recount == (4, 3)
