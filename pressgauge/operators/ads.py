"""Ad texts from the text nodes of ad cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.text import content_hash, slug, trim_space
from pressgauge.functions.values import col_of, first_truthy
from pressgauge.operators.dedup import top_k

# One visit of one search page: every cut and every card belongs to a run.
PAGE = ["fetched_at", "term", "country"]
CARD = [*PAGE, "container_pos"]
NODES_PER_PIECE = 256
UNKNOWN_ADVERTISER = "Unknown Advertiser"


def keep_node(text: Column | str) -> Column:
    """Nodes worth keeping: longer than 20 characters, no clock time, no sponsor mark."""
    text = col_of(text)
    return (
        (F.length(text) > C.AD_NODE_MIN_CHARS)
        & ~text.rlike(r"^\d+:\d+")
        & ~F.contains(text, F.lit("Sponsored"))
    )


def assemble_ads(
    nodes: DataFrame, per_page: int | None = C.ADS_PER_PAGE, min_len: int = C.AD_MIN_CHARS
) -> DataFrame:
    """Ad text per card: kept nodes joined in document order, long enough, first few per page.

    Joining goes through pieces of a few hundred nodes, so one giant card is
    sorted and joined in parallel and no task collects all of its nodes.
    ``per_page=None`` keeps every card.
    """
    trimmed = nodes.withColumn("text", trim_space("text"))
    pieces = (
        trimmed.withColumn("kept_text", F.when(keep_node("text"), F.col("text")))
        .withColumn("piece", F.floor(F.col("node_pos") / NODES_PER_PIECE))
        .groupBy(*CARD, "piece")
        .agg(
            F.array_sort(
                F.collect_list(F.when(F.col("kept_text").isNotNull(), F.struct("node_pos", "kept_text")))
            ).alias("kept"),
            F.max("advertiser_name").alias("advertiser_name"),
        )
        .withColumn("text", F.concat_ws(" ", F.transform("kept", lambda x: x["kept_text"])))
    )
    cards = (
        pieces.groupBy(*CARD)
        .agg(
            F.array_sort(
                F.collect_list(F.when(F.col("text") != "", F.struct("piece", "text")))
            ).alias("texts"),
            F.max("advertiser_name").alias("advertiser_name"),
        )
        .select(
            *CARD,
            F.concat_ws(" ", F.transform("texts", lambda x: x["text"])).alias("ad_text"),
            first_truthy(trim_space("advertiser_name"), F.lit(UNKNOWN_ADVERTISER)).alias("advertiser_name"),
        )
        .filter(F.length("ad_text") >= min_len)
    )
    return cards if per_page is None else top_k(cards, PAGE, ["container_pos"], per_page)


def _usable_blocks(blocks: DataFrame, min_len: int) -> DataFrame:
    trimmed = blocks.withColumn("ad_text", trim_space("text"))
    return trimmed.filter(
        (F.length("ad_text") >= min_len)
        & ~F.contains("ad_text", F.lit("Log in"))
        & ~F.contains("ad_text", F.lit("Facebook"))
    ).select(*CARD, "ad_text", F.lit(UNKNOWN_ADVERTISER).alias("advertiser_name"))


def fallback_ads(
    blocks: DataFrame,
    primary: DataFrame,
    per_page: int = C.ADS_PER_PAGE,
    min_len: int = C.AD_MIN_CHARS,
) -> DataFrame:
    """Large text blocks of pages where no card was found."""
    missed = _usable_blocks(blocks, min_len).join(primary.select(*PAGE).distinct(), PAGE, "left_anti")
    return top_k(missed, PAGE, ["container_pos"], per_page)


def page_ads(
    nodes: DataFrame,
    blocks: DataFrame,
    per_page: int = C.ADS_PER_PAGE,
    min_len: int = C.AD_MIN_CHARS,
) -> DataFrame:
    """Ads of every page, cards where there are any and fallback blocks elsewhere.

    Same rows as the two functions above together, but cards are assembled
    once: cards rank before blocks, and of the few rows kept per page only
    those of the better kind stay.
    """
    both = (
        assemble_ads(nodes, None, min_len)
        .withColumn("_kind", F.lit(0))
        .unionByName(_usable_blocks(blocks, min_len).withColumn("_kind", F.lit(1)))
    )
    best = top_k(both, PAGE, ["_kind", "container_pos"], per_page)
    return (
        best.withColumn("_best", F.min("_kind").over(Window.partitionBy(*PAGE)))
        .filter(F.col("_kind") == F.col("_best"))
        .drop("_kind", "_best")
    )


def ads_per_term(ads: DataFrame, grid: DataFrame, k: int = C.ADS_PER_TERM) -> DataFrame:
    """At most ``k`` ads per run and term over all its countries, the first country filling first.

    ``term_pos`` is an ad's place among those of its term.
    """
    placed = ads.join(grid, ["term", "country"])
    order = Window.partitionBy("fetched_at", "term").orderBy("country_ordinal", "container_pos")
    return placed.withColumn("term_pos", F.row_number().over(order)).filter(F.col("term_pos") <= k)


def ad_candidates(ads: DataFrame, headline_chars: int = C.HEADLINE_CHARS) -> DataFrame:
    """Queue fields of placed ads; an ad belongs to the run of its ``fetched_at``."""
    in_us = F.col("country") == "US"
    url = F.concat(
        F.lit("https://www.facebook.com/ads/library/?active_status=active&ad_type=all&country="),
        F.col("country"),
        F.lit("&q="),
        F.replace(F.url_encode("term"), F.lit("+"), F.lit("%20")),
        F.lit("&media_type=all"),
    )
    return ads.select(
        content_hash("ad_text").alias("content_hash"),
        F.lit("facebook_ad").alias("source_type"),
        url.alias("feed_url"),
        F.col("advertiser_name").alias("publisher_name"),
        slug("advertiser_name").alias("publisher_domain"),
        F.when(in_us, "US").otherwise("UK").alias("region"),
        F.when(in_us, "United States").otherwise("United Kingdom").alias("country"),
        F.lit("facebook_ad").alias("media_class"),
        F.col("category").alias("topic_class"),
        url.alias("article_url"),
        F.lit("facebook.com").alias("article_domain"),
        F.substring("ad_text", 1, headline_chars).alias("headline_text"),
        F.col("ad_text").alias("body_text"),
        F.length("ad_text").alias("content_length"),
        F.lit(False).alias("truncated"),
        F.lit("facebook_ad_body").alias("content_extraction_type"),
        F.lit("en").alias("language"),
        F.lit("assumed").alias("language_confidence"),
        F.lit(True).alias("in_distribution"),
        "advertiser_name",
        F.col("term").alias("search_term"),
        F.col("country").alias("ad_country"),
        "fetched_at",
        F.lit(2).alias("phase"),
        F.col("term_ordinal").alias("feed_ordinal"),
        F.col("term_pos").alias("item_pos"),
    )
