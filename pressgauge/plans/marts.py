"""Weekly marts and the daily health report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.values import rounded_avg, week_of


def in_scope(scans: DataFrame) -> DataFrame:
    """Successful scans in a calibrated language; a NULL flag counts as out."""
    return scans.filter("scan_status = 'success' and in_distribution = true")


def benchmarkable(scans: DataFrame) -> DataFrame:
    """In-scope scans that have a score."""
    return in_scope(scans).filter("spi_score is not null")


def domain_integrity_weekly(scans: DataFrame, ordered: bool = False) -> DataFrame:
    """Score statistics per publisher and week."""
    mart = (
        benchmarkable(scans)
        .groupBy(
            "publisher_domain",
            "publisher_name",
            "media_class",
            "region",
            "country",
            week_of("scanned_at").alias("week"),
            "taxonomy_version",
        )
        .agg(
            rounded_avg("spi_score").alias("avg_spi"),
            F.count("*").alias("scan_count"),
            F.min("spi_score").alias("min_spi"),
            F.max("spi_score").alias("max_spi"),
        )
    )
    if ordered:
        mart = mart.orderBy(F.col("week").desc_nulls_first(), F.col("avg_spi").desc_nulls_first())
    return mart


DOMAIN_KEYS = ("publisher_domain", "publisher_name", "media_class", "region", "country", "week", "taxonomy_version")


def domain_partials(scans: DataFrame) -> DataFrame:
    """Sums of the domain mart that add up over batches of scans."""
    return (
        benchmarkable(scans)
        .withColumn("week", week_of("scanned_at"))
        .groupBy(*DOMAIN_KEYS)
        .agg(
            F.sum(F.col("spi_score").cast("long")).alias("spi_sum"),
            F.count("*").alias("scan_count"),
            F.min("spi_score").alias("min_spi"),
            F.max("spi_score").alias("max_spi"),
        )
    )


def add_domain_partials(partials: DataFrame) -> DataFrame:
    """Partial sums of the domain mart added up per key, still partial."""
    return partials.groupBy(*DOMAIN_KEYS).agg(
        F.sum("spi_sum").alias("spi_sum"),
        F.sum("scan_count").alias("scan_count"),
        F.min("min_spi").alias("min_spi"),
        F.max("max_spi").alias("max_spi"),
    )


def merge_domain_partials(partials: DataFrame) -> DataFrame:
    """The domain mart from partial sums; the same rows as from the scans themselves."""
    mean = F.sum("spi_sum") / F.sum("scan_count")
    return partials.groupBy(*DOMAIN_KEYS).agg(
        F.round(mean).cast("int").alias("avg_spi"),
        F.sum("scan_count").alias("scan_count"),
        F.min("min_spi").alias("min_spi"),
        F.max("max_spi").alias("max_spi"),
    )


def tactic_frequency_weekly(tactics: DataFrame, scans: DataFrame, ordered: bool = False) -> DataFrame:
    """Occurrences per tactic, week, region and media class.

    Every tactic row counts, so a scan that shows a tactic twice weighs twice
    in the mean. Scans are filtered and narrowed before the join and are one
    row per key; a scan with very many tactics is a skew on the streamed side,
    which adaptive execution splits.
    """
    facts = in_scope(scans).select(
        "scan_id", week_of("scanned_at").alias("week"), "region", "media_class", "spi_score"
    )
    mart = (
        tactics.select("scan_id", "tactic_code", "tactic_label", "taxonomy_version")
        .join(facts, "scan_id")
        .groupBy("tactic_code", "tactic_label", "week", "region", "media_class", "taxonomy_version")
        .agg(F.count("*").alias("occurrences"), rounded_avg("spi_score").alias("avg_spi_when_present"))
    )
    if ordered:
        mart = mart.orderBy(F.col("week").desc_nulls_first(), F.col("occurrences").desc_nulls_first())
    return mart


TACTIC_KEYS = ("tactic_code", "tactic_label", "week", "region", "media_class", "taxonomy_version")


def tactic_partials(pairs: DataFrame) -> DataFrame:
    """Sums of the tactic mart that add up over batches of tactic rows joined with their scans."""
    return (
        in_scope(pairs)
        .withColumn("week", week_of("scanned_at"))
        .groupBy(*TACTIC_KEYS)
        .agg(
            F.count("*").alias("occurrences"),
            F.count("spi_score").alias("scored"),
            F.coalesce(F.sum(F.col("spi_score").cast("long")), F.lit(0).cast("long")).alias("spi_sum"),
        )
    )


def add_tactic_partials(partials: DataFrame) -> DataFrame:
    """Partial sums of the tactic mart added up per key, still partial."""
    return partials.groupBy(*TACTIC_KEYS).agg(*(F.sum(c).alias(c) for c in ("occurrences", "scored", "spi_sum")))


def merge_tactic_partials(partials: DataFrame) -> DataFrame:
    """The tactic mart from partial sums; the same rows as from the scans and tactics themselves."""
    sums = add_tactic_partials(partials)
    mean = F.when(F.col("scored") > 0, F.round(F.col("spi_sum") / F.col("scored")).cast("int"))
    return sums.withColumn("avg_spi_when_present", mean).drop("scored", "spi_sum")


def daily_health(scans: DataFrame) -> DataFrame:
    """Scans, mean score and out-of-distribution scans per day and status."""
    return scans.groupBy(F.date_trunc("day", "scanned_at").alias("day"), "scan_status").agg(
        F.count("*").alias("scans"),
        rounded_avg("spi_score").alias("avg_spi"),
        F.count_if(F.col("in_distribution") == F.lit(False)).alias("out_of_dist"),
    )


def version_profile(scans: DataFrame) -> DataFrame:
    """Scans and score spread per version set and distribution flag."""
    return scans.groupBy("analyzer_version", "taxonomy_version", "prompt_version", "in_distribution").agg(
        F.count("*").alias("scans"),
        F.count("spi_score").alias("scored"),
        rounded_avg("spi_score").alias("avg_spi"),
        F.min("spi_score").alias("min_spi"),
        F.max("spi_score").alias("max_spi"),
    )
