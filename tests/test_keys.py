"""Domains, labels, dates and choices between columns."""

import datetime as dt

from pyspark.sql import functions as F

from pressgauge.functions.dates import date_is_bad, parse_published
from pressgauge.functions.labels import derive_credibility, normalise_bias, normalise_factuality
from pressgauge.functions.urls import article_domain, article_domain_v1, extract_domain, lookup_key, normalise_domain
from pressgauge.functions.values import first_truthy, rounded_avg, week_of


def test_extract_domain(one):
    assert one(
        extract_domain,
        "https://WWW.Example.com/a?b#c",
        "http://user:pw@host.example:8080/x",
        "https://www.www.x.example",
        "no-scheme.example/a",
        "https://has space.example/",
        "https://under_score.example/",
        "https://x.example?y=1",
        "",
        None,
    ) == [
        "example.com",
        "host.example",
        "www.x.example",
        None,
        None,
        "under_score.example",
        "x.example",
        None,
        None,
    ]


def test_normalise_domain(one):
    assert one(
        normalise_domain,
        "HTTPS://WWW.Site.example/path?q",
        "site.example:8080/a",
        "https://x.example?y",
        "www.www.x.example",
        " padded.example ",
        "",
        None,
    ) == ["site.example", "site.example:8080", "x.example?y", "www.x.example", "padded.example", None, None]


def test_lookup_key(one):
    assert one(lookup_key, "WWW.A.example", "b.example", None) == ["a.example", "b.example", None]


def test_article_domain_precedence(spark):
    df = spark.createDataFrame(
        [("https://a.example/1", "feed.example"), ("bad", "feed.example"), ("https://a.example/1", "")],
        "u string, f string",
    )
    rows = df.select(article_domain("u", "f"), article_domain_v1("u", "f")).collect()
    assert [tuple(r) for r in rows] == [
        ("a.example", "feed.example"),
        ("feed.example", "feed.example"),
        ("a.example", "a.example"),
    ]


def test_labels(one):
    assert one(normalise_bias, "LEFT-CENTER ", "least biased", "Centrist  ", "", None) == [
        "Left-Center", "Least Biased", "Centrist  ", None, None,
    ]
    assert one(normalise_factuality, " very LOW", "n/a", "Unrated", "") == ["Very Low", "N/A", "Unrated", None]


def test_credibility_order(spark):
    df = spark.createDataFrame(
        [("Extreme Left", "High"), ("Left", "Low"), ("Left", "Very High"), ("Left", "Mixed"), (None, None)],
        "b string, f string",
    )
    assert [r[0] for r in df.select(derive_credibility("b", "f")).collect()] == [
        "DISPUTED", "LOW", "HIGH", "MIXED", "MIXED",
    ]


def test_dates(one):
    noon = dt.datetime(2024, 3, 5, 12, 0)
    raw = (
        "Tue, 05 Mar 2024 12:00:00 GMT",
        "Tue, 5 Mar 2024 14:00:00 +0200",
        "2024-03-05T07:00:00-05:00",
        "20240305T120000Z",
        "soon",
        "",
        None,
    )
    assert one(lambda c: F.date_format(parse_published(c), "yyyy-MM-dd HH:mm"), *raw) == [
        *[noon.strftime("%Y-%m-%d %H:%M")] * 4, None, None, None,
    ]
    assert one(date_is_bad, *raw) == [False, False, False, False, True, False, False]


def test_falsy_and_nullish(spark):
    df = spark.createDataFrame([("", "b", "c"), (None, "", "c"), (None, "", ""), ("a", "b", "c")], "x string, y string, z string")
    assert [r[0] for r in df.select(first_truthy("x", "y", "z")).collect()] == ["b", "c", "", "a"]
    assert [r[0] for r in df.select(F.coalesce("x", "y", "z")).collect()] == ["", "", "", "a"]


def test_week_starts_on_monday(spark):
    df = spark.sql("select * from values (timestamp '2024-03-03 23:59:59'), (timestamp '2024-03-04 00:00:00') as t(ts)")
    assert [r[0] for r in df.select(F.date_format(week_of("ts"), "yyyy-MM-dd")).collect()] == ["2024-02-26", "2024-03-04"]


def test_mean_rounds_half_away_from_zero(spark):
    df = spark.sql("select * from values (1, 2), (1, 3), (2, -2), (2, -3) as t(g, v)")
    assert {r[0]: r[1] for r in df.groupBy("g").agg(rounded_avg("v")).collect()} == {1: 3, 2: -3}
