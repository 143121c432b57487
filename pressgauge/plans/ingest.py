"""From landed feeds, discovery lists, ads and pages to queue candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.dates import date_is_bad, parse_published
from pressgauge.functions.text import (
    content_hash,
    detect_language,
    html_to_text,
    is_truncated,
    long_enough,
    strip_markup,
)
from pressgauge.functions.values import first_truthy, with_computed
from pressgauge.operators.content import all_candidates, min_length
from pressgauge.operators.dedup import ORDER, first_wins, not_held, run_outcomes


def with_page_text(items: DataFrame, pages: DataFrame, max_chars: int | None = C.CONTENT_MAX_CHARS) -> DataFrame:
    """Page text of each item; items whose page is missing or too short are dropped.

    Text is extracted in the page scan, below the join, so the exchange carries
    the cut text and never the HTML. Pages are one row per URL and run where they
    have a ``fetched_at``, and one per URL otherwise. ``max_chars=None`` stores whole texts.
    """
    run = ["fetched_at"] if "fetched_at" in pages.columns else []
    full = with_computed(pages.select("url", "html", *run), "full_text", strip_markup("html"))
    text = F.col("full_text") if max_chars is None else F.substring("full_text", 1, max_chars)
    texts = full.select(
        F.col("url").alias("article_url"),
        *run,
        text.alias("body_text"),
        F.length("full_text").alias("content_length_full"),
    )
    return items.join(min_length(texts, "body_text"), ["article_url", *run])


def ingest_summary(
    items: DataFrame, pages: DataFrame, queued: DataFrame, scanned: DataFrame
) -> DataFrame:
    """What became of every article item of a run, per source type.

    An item whose page was not landed is an ``error``, one with too little text
    is ``too_short``; the rest are queued or skipped. Only hashes and lengths
    leave the page scan.
    """
    run = ["fetched_at"] if "fetched_at" in pages.columns else []
    full = with_computed(pages.select("url", "html", *run), "body_text", html_to_text("html"))
    texts = full.select(
        F.col("url").alias("article_url"),
        *run,
        long_enough("body_text").alias("usable"),
        F.when(long_enough("body_text"), content_hash("body_text")).alias("content_hash"),
    )
    state = F.when(F.col("usable").isNull(), "error").when(~F.col("usable"), "too_short")
    judged = items.select("source_type", "article_url", *ORDER).join(texts, ["article_url", *run], "left")
    return run_outcomes(judged.withColumn("lost", state), queued, scanned)


def with_content_fields(items: DataFrame) -> DataFrame:
    """Hash, length, truncation and language of the stored text."""
    language = detect_language("body_text")
    return (
        items.withColumn("_lang", language)
        .withColumns(
            {
                "content_hash": content_hash("body_text"),
                "content_length": F.length("body_text"),
                "truncated": is_truncated("body_text"),
                "content_extraction_type": F.lit("html_strip"),
                "language": F.col("_lang.lang"),
                "language_confidence": F.col("_lang.confidence"),
                "in_distribution": F.col("_lang.in_distribution"),
                "published_at": parse_published("published_raw"),
                "published_bad": date_is_bad("published_raw"),
            }
        )
        .drop("_lang", "published_raw")
    )


def with_queue_constants(candidates: DataFrame) -> DataFrame:
    """Defaults, status, queue time and version stamps of a new queue row.

    Ads carry no queue time, so they are claimed after everything that has one.
    """
    none = F.lit(None).cast("string")
    region = F.col("region") if "region" in candidates.columns else none
    return candidates.withColumns(
        {
            "publisher_name": first_truthy("publisher_name", "article_domain"),
            "publisher_domain": first_truthy("publisher_domain", "article_domain"),
            "region": region,
            "country": first_truthy("country", none),
            "media_class": first_truthy("media_class", none),
            "topic_class": first_truthy("topic_class", none),
            "status": F.lit("pending"),
            "queued_at": F.when(F.col("source_type") != "facebook_ad", F.col("fetched_at")),
            "analyzer_version": F.lit(C.ANALYZER_VERSION),
            "taxonomy_version": F.lit(C.TAXONOMY_VERSION),
            "prompt_version": F.lit(C.PROMPT_VERSION),
        }
    )


def article_candidates(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Complete candidates from article items and their pages."""
    return with_queue_constants(with_content_fields(with_page_text(items, pages)))


def collect_run(
    feed_items: DataFrame, discovery_items: DataFrame, start: int = 0
) -> DataFrame:
    """Article items of one batch; discovery belongs to the batch that starts at feed 0."""
    return all_candidates(feed_items, discovery_items) if start == 0 else feed_items


def new_queue_rows(candidates: DataFrame, queued: DataFrame, scanned: DataFrame) -> DataFrame:
    """Candidates to append: the first of each text that is neither queued nor scanned.

    Within the run copies are dropped map-side before anything is compared
    with the known hashes, so both joins see one row per hash.
    """
    fresh = first_wins(candidates, ["content_hash"], ORDER)
    return not_held(fresh, queued, scanned)
