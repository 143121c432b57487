"""Tactic analytics. Every join here follows a narrowing of the scan side."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.plans.marts import in_scope


def _counts_by_scan_column(tactics: DataFrame, scans: DataFrame, column: str) -> DataFrame:
    facts = in_scope(scans).select("scan_id", column)
    return (
        tactics.select("scan_id", "tactic_code")
        .join(facts, "scan_id")
        .groupBy(column, "tactic_code")
        .agg(F.count("*").alias("occurrences"))
    )


def top_tactics_by_publisher(tactics: DataFrame, scans: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` most frequent tactics per publisher, ties by code."""
    counts = _counts_by_scan_column(tactics, scans, "publisher_name")
    rank = F.row_number().over(
        Window.partitionBy("publisher_name").orderBy(F.desc("occurrences"), F.asc("tactic_code"))
    )
    return counts.withColumn("position", rank).filter(F.col("position") <= k)


def tactics_by_region(tactics: DataFrame, scans: DataFrame) -> DataFrame:
    """Occurrences and share of the region's total; the NULL region is a region of its own."""
    counts = _counts_by_scan_column(tactics, scans, "region")
    total = F.sum("occurrences").over(Window.partitionBy("region"))
    return counts.withColumn("share", F.round(F.col("occurrences") / total, 6))


def tactic_spi_corr(tactics: DataFrame, scans: DataFrame) -> DataFrame:
    """Correlation of a tactic's presence with the score, over all in-scope scored scans.

    Computed from sums: presence is 0 or 1, so only the scans that show the
    tactic have to be visited per code; the totals come from one scalar
    subquery each and no scan x code table exists.
    """
    scored = in_scope(scans).filter("spi_score is not null").select(
        "scan_id", F.col("spi_score").cast("double").alias("y")
    )
    per_code = (
        tactics.filter("tactic_code is not null")
        .select("scan_id", "tactic_code")
        .distinct()
        .join(scored, "scan_id")
        .groupBy("tactic_code")
        .agg(F.count("*").alias("n_with"), F.sum("y").alias("y_with"))
    )
    totals = scored.agg(
        F.struct(
            F.count("*").alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy")
        ).alias("t")
    ).scalar()
    # doubles: products of two counts exceed a long
    n, sy, syy = F.col("t.n").cast("double"), F.col("t.sy"), F.col("t.syy")
    sx, sxy = F.col("n_with").cast("double"), F.col("y_with")
    spread = (n * sx - sx * sx) * (n * syy - sy * sy)
    corr = F.when(spread > 0, (n * sxy - sx * sy) / F.sqrt(spread))
    return per_code.withColumn("t", totals).select(
        "tactic_code",
        F.col("n_with").alias("scans_with"),
        F.col("t.n").alias("scans"),
        F.round(corr, 6).alias("corr_spi"),
    )


def tactic_rollup(tactics: DataFrame) -> DataFrame:
    """Rows per pattern prefix and code, with category totals and a grand total.

    Codes are counted first, so the rollup expands one row per code.
    """
    per_code = tactics.filter("tactic_code is not null").groupBy("tactic_code").agg(F.count("*").alias("n"))
    return (
        per_code.withColumn("prefix", F.substring("tactic_code", 1, 1))
        .rollup("prefix", "tactic_code")
        .agg(F.sum("n").alias("occurrences"), F.grouping_id().cast("int").alias("level"))
    )


def emerging_tactics(tactics: DataFrame, scans: DataFrame) -> DataFrame:
    """Occurrences per quarter and their change, from a tactic's first quarter to the last one seen.

    Quarters without the tactic are filled with 0, so the change always refers
    to the quarter before.
    """
    facts = in_scope(scans).select("scan_id", F.date_trunc("quarter", "scanned_at").alias("quarter"))
    counts = (
        tactics.filter("tactic_code is not null")
        .select("scan_id", "tactic_code")
        .join(facts, "scan_id")
        .groupBy("tactic_code", "quarter")
        .agg(F.count("*").alias("occurrences"))
    )
    last_quarter = facts.agg(F.max("quarter").alias("q")).scalar()
    by_quarter = Window.partitionBy("tactic_code").orderBy("quarter")
    # each counted quarter is followed by the quiet ones up to the next counted one
    spans = counts.withColumns(
        {
            "next_quarter": F.lead("quarter").over(by_quarter),
            "first_quarter": F.min("quarter").over(Window.partitionBy("tactic_code")),
            "last_quarter": last_quarter,
        }
    )
    filled = spans.select(
        "tactic_code",
        "first_quarter",
        F.col("occurrences").alias("n"),
        F.posexplode(
            F.expr(
                "sequence(quarter, coalesce(next_quarter - interval 3 months, last_quarter), interval 3 months)"
            )
        ).alias("step", "quarter"),
    ).withColumn("occurrences", F.when(F.col("step") == 0, F.col("n")).otherwise(F.lit(0).cast("bigint")))
    return filled.select(
        "tactic_code",
        "quarter",
        "occurrences",
        (F.col("occurrences") - F.lag("occurrences").over(by_quarter)).alias("change"),
        (F.col("quarter") == F.col("first_quarter")).alias("first_seen"),
    )


def audience_counts(tactics: DataFrame, routing: DataFrame) -> DataFrame:
    """Tactic rows per audience; codes are counted before they are routed."""
    used = tactics.filter("tactic_code is not null").groupBy("tactic_code").agg(F.count("*").alias("n"))
    return (
        routing.withColumnRenamed("pattern_id", "tactic_code")
        .join(used, "tactic_code", "left")
        .groupBy("audience")
        .agg(
            F.count("*").alias("patterns"),
            F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("occurrences"),
        )
    )
