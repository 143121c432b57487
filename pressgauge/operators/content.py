"""Filters and derivations on articles and scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.text import long_enough
from pressgauge.functions.urls import article_domain
from pressgauge.functions.values import col_of, with_computed


def min_length(df: DataFrame, column: str, n: int = C.CONTENT_MIN_CHARS) -> DataFrame:
    """Rows whose text is present and long enough."""
    return df.filter(long_enough(column, n))


def recent(df: DataFrame, ts: str, as_of: Column | str, days: int = 1) -> DataFrame:
    """Rows of the last ``days`` days up to ``as_of``."""
    as_of = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    since = as_of - F.make_dt_interval(F.lit(days))
    return df.filter((F.col(ts) >= since) & (F.col(ts) <= as_of))


def theme_matches(
    articles: DataFrame, text: str = "body_text", themes=C.THEMES, key: str = "doc_id"
) -> DataFrame:
    """One row per (article, theme) where a theme's phrase occurs, ignoring case.

    Each theme is a native predicate over one lower-cased column, so articles
    are read once and never joined with the phrase list.
    """
    lowered = with_computed(articles.select(key, text), "_text", F.lower(col_of(text)))

    def occurs(phrase: str) -> Column:
        return F.contains("_text", F.lit(phrase.lower()))

    def matched(phrases: tuple[str, ...], required: str | None) -> Column:
        any_phrase = reduce(lambda a, b: a | b, [occurs(p) for p in phrases])
        return any_phrase & occurs(required) if required else any_phrase

    hits = F.array_compact(F.array(*[F.when(matched(p, r), F.lit(t)) for t, p, r in themes]))
    return lowered.select(key, F.explode_outer(hits).alias("theme")).filter("theme is not null")


def with_feed(items: DataFrame, feed_rows: DataFrame) -> DataFrame:
    """Feed metadata on each item; feeds that are not listed drop out."""
    return items.join(feed_rows, "feed_url").select(
        F.lit("rss_article").alias("source_type"),
        "feed_url",
        F.col("name").alias("publisher_name"),
        F.col("domain").alias("publisher_domain"),
        "country",
        "media_class",
        "topic_class",
        F.col("url").alias("article_url"),
        article_domain("url", "domain").alias("article_domain"),
        F.col("title").alias("headline_text"),
        "published_raw",
        "fetched_at",
        F.lit(0).alias("phase"),
        F.col("ordinal").alias("feed_ordinal"),
        F.col("pos").alias("item_pos"),
    )


def all_candidates(*sources: DataFrame) -> DataFrame:
    """Candidates of every source in one table; columns a source lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)


def with_provenance(df: DataFrame) -> DataFrame:
    """Scan provenance by source type; ads keep their own fields and a fixed domain."""
    is_ad = F.col("source_type") == "facebook_ad"
    return df.withColumns(
        {
            "scan_source": F.when(is_ad, "facebook_ad_scraper").otherwise("crawler"),
            "gdelt_source": F.col("source_type") == "gdelt_article",
            "article_domain": F.when(is_ad, "facebook.com").otherwise(F.col("article_domain")),
            "analysis_scope": F.when(is_ad, "copy_only"),
            "advertiser_name": F.when(is_ad, F.col("advertiser_name")),
            "search_term": F.when(is_ad, F.col("search_term")),
            "ad_country": F.when(is_ad, F.col("ad_country")),
        }
    )


# Column defaults of the scan table.
COLUMN_DEFAULTS = {
    "truncated": False,
    "language": "en",
    "language_confidence": "heuristic",
    "in_distribution": True,
    "scan_source": "crawler",
    "scan_status": "success",
}


def canonicalise_v1(rows: DataFrame) -> DataFrame:
    """Rows of the older scan layout under the current column names."""
    renamed = rows.withColumnsRenamed(
        {
            "article_title": "headline_text",
            "article_published_at": "published_at",
            "content_length_chars": "content_length",
        }
    )
    # a column the older layout did not write has the default of the table
    absent = {k: F.lit(v) for k, v in COLUMN_DEFAULTS.items() if k not in renamed.columns}
    return renamed.drop("feed_name").withColumns(
        {
            **absent,
            "publisher_domain": F.col("article_domain"),
            "analyzer_version": F.lit(C.LEGACY_VERSION),
            "taxonomy_version": F.lit(C.LEGACY_VERSION),
            "prompt_version": F.lit(C.LEGACY_VERSION),
        }
    )
