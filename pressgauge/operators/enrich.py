"""Joins with the credibility dimension.

No broadcast is forced: the dimension is broadcast when its measured size is
below the session's threshold and sort-merged, with skew splitting for hot
domains, when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.urls import lookup_key
from pressgauge.functions.values import rounded_avg
from pressgauge.operators.dedup import first_wins

MEASURES = ("mbfc_bias", "mbfc_factuality", "mbfc_credibility")


def scans_enriched(scans: DataFrame, dimension: DataFrame) -> DataFrame:
    """All scan columns plus the dimension's labels as ``de_*``."""
    de = dimension.select(
        F.col("domain").alias("_domain"),
        F.col("mbfc_bias").alias("de_bias"),
        F.col("mbfc_factuality").alias("de_factuality"),
        F.col("mbfc_credibility").alias("de_credibility"),
    )
    return scans.join(de, F.col("article_domain") == F.col("_domain"), "left").drop("_domain")


def _hit(dimension: DataFrame, key: str, hit: str) -> DataFrame:
    return dimension.select(F.col("domain").alias(key), F.struct(*MEASURES).alias(hit))


def credibility_lookup(df: DataFrame, dimension: DataFrame, mode: str = "fallback") -> DataFrame:
    """Attach the dimension's labels to each row.

    ``fallback`` tries the article's domain, then the publisher's. A hit is one
    struct, so a first hit with a NULL label never borrows from the second.
    ``exact`` compares the article's domain as written and has no second try.
    """
    if mode == "exact":
        found = df.join(_hit(dimension, "_k1", "_hit"), F.col("article_domain") == F.col("_k1"), "left")
        return found.select(*df.columns, *[F.col(f"_hit.{m}").alias(m) for m in MEASURES])
    keyed = df.withColumns(
        {"_a": lookup_key("article_domain"), "_p": lookup_key("publisher_domain")}
    )
    found = keyed.join(_hit(dimension, "_k1", "_first"), F.col("_a") == F.col("_k1"), "left").join(
        _hit(dimension, "_k2", "_second"), F.col("_p") == F.col("_k2"), "left"
    )
    hit = F.coalesce("_first", "_second")
    return found.select(*df.columns, *[hit[m].alias(m) for m in MEASURES])


def enrichment_coverage(scans: DataFrame, dimension: DataFrame) -> DataFrame:
    """Scans whose article domain the dimension knows."""
    known = dimension.select(F.col("domain").alias("article_domain"))
    return scans.join(known, "article_domain", "left_semi")


def upsert_snapshot(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New snapshot: rows of ``new`` replace rows of ``old`` with the same key, whole rows at a time.

    One exchange over both sides; columns one side lacks are NULL.
    """
    both = new.withColumn("_age", F.lit(0)).unionByName(
        old.withColumn("_age", F.lit(1)), allowMissingColumns=True
    )
    return first_wins(both, [key], ["_age"]).drop("_age")


def preview(df: DataFrame, columns: list[str], n: int = 5) -> DataFrame:
    """First ``n`` rows by the first column, for a spot check."""
    return df.select(*columns).orderBy(columns[0]).limit(n)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def score_by_credibility(enriched: DataFrame) -> DataFrame:
    """Scans and mean score per credibility tier; unknown domains are the NULL tier."""
    return enriched.groupBy("de_credibility").agg(
        F.count("*").alias("scans"), rounded_avg("spi_score").alias("avg_spi")
    )
