"""Discovery lists: JSON article lists per theme."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.urls import extract_domain
from pressgauge.functions.values import first_truthy
from pressgauge.operators.dedup import top_k

DISCOVERY_SCHEMA = (
    "articles array<struct<url:string,domain:string,title:string,"
    "seendate:string,tone:variant,language:string>>"
)


def parse_discovery(payloads: DataFrame) -> DataFrame:
    """``payloads(theme_ordinal, theme, fetched_at, body)`` to one row per listed article."""
    listed = payloads.select(
        "theme_ordinal",
        "theme",
        "fetched_at",
        F.posexplode(F.from_json("body", DISCOVERY_SCHEMA)["articles"]).alias("idx", "a"),
    )
    return listed.select(
        "theme_ordinal",
        "theme",
        "fetched_at",
        (F.col("idx") + 1).alias("pos"),
        F.col("a.url").alias("url"),
        F.col("a.domain").alias("listed_domain"),
        F.col("a.title").alias("title"),
        F.col("a.seendate").alias("seendate"),
        F.col("a.tone").alias("tone_raw"),
        F.col("a.language").alias("source_language"),
    )


def valid_discovery(items: DataFrame) -> DataFrame:
    """Items with a URL whose host can be read; adds ``article_domain``."""
    return items.withColumn("article_domain", extract_domain("url")).filter(
        (F.col("url") != "") & (F.col("article_domain") != "")
    )


def v1_discovery_fields(items: DataFrame) -> DataFrame:
    """Country and tone as the older crawler kept them: tone only when a JSON number."""
    kind = F.schema_of_variant("tone_raw")
    numeric = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    return items.withColumns(
        {
            "country": F.when(F.col("source_language") == "Russian", "RU"),
            "gdelt_tone": F.when(numeric, F.try_variant_get("tone_raw", "$", "double")),
        }
    ).drop("tone_raw")


def discovery_candidates(items: DataFrame) -> DataFrame:
    """Publisher and topic metadata of valid discovery items."""
    none = F.lit(None).cast("string")
    return items.select(
        F.lit("gdelt_article").alias("source_type"),
        none.alias("feed_url"),
        first_truthy("listed_domain", "article_domain").alias("publisher_name"),
        F.col("article_domain").alias("publisher_domain"),
        none.alias("country"),
        F.lit("GDELT Discovery").alias("media_class"),
        F.col("theme").alias("topic_class"),
        F.col("url").alias("article_url"),
        "article_domain",
        F.coalesce("title", F.lit("")).alias("headline_text"),
        first_truthy("seendate", none).alias("published_raw"),
        F.lit(1).alias("phase"),
        F.col("theme_ordinal").alias("feed_ordinal"),
        "fetched_at",
        F.col("pos").alias("item_pos"),
    )


def per_run_cut(items: DataFrame, budget: int | None = C.DISCOVERY_BUDGET) -> DataFrame:
    """The first items of each theme and run, an equal share of the run's budget; ``None`` keeps all."""
    if budget is None:
        return items
    return top_k(items, ["theme", "fetched_at"], ["pos"], -(-budget // len(C.THEMES)))
