"""From claimed queue items and landed responses to scans and tactic rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.tactics import tactic_vector
from pressgauge.operators.content import with_provenance
from pressgauge.operators.enrich import credibility_lookup
from pressgauge.operators.tactic_rows import flatten_tactics
from pressgauge.sources.responses import parse_responses


def scans_from_responses(
    items: DataFrame, responses: DataFrame, dimension: DataFrame, scanned_at: Column | None = None
) -> DataFrame:
    """Scan rows of items that have a usable response; failed ones give events and no scan.

    ``scan_id`` is the content hash, which is unique, so a retried task writes
    the same id. The body text is dropped before any exchange.
    """
    parsed = parse_responses(responses).filter("error_message is null").drop("error_message")
    joined = items.drop("body_text").join(parsed, "content_hash")
    looked_up = credibility_lookup(joined, dimension)
    return with_provenance(looked_up).withColumns(
        {
            "scan_id": F.col("content_hash"),
            "scan_status": F.lit("success"),
            "scanned_at": F.current_timestamp() if scanned_at is None else scanned_at,
            "tactic_vector": tactic_vector(F.col("tactics")),
            "gdelt_tone": F.lit(None).cast("double"),
        }
    )


def tactics_from_scans(scans: DataFrame) -> DataFrame:
    """Tactic rows of freshly analysed scans."""
    return flatten_tactics(scans)


def status_events(responses: DataFrame, at: Column | None = None) -> DataFrame:
    """What analysing does to each item: ``processing``, then ``done``, or ``error`` with the reason.

    ``step`` orders the events of one item.
    """
    judged = parse_responses(responses).select("content_hash", "error_message")
    failed = F.col("error_message").isNotNull()
    events = F.array(
        F.struct(F.lit(1).alias("step"), F.lit("processing").alias("status"), F.lit(None).cast("string").alias("error_message")),
        F.struct(F.lit(2).alias("step"), F.when(failed, "error").otherwise("done").alias("status"), F.col("error_message")),
    )
    moment = F.current_timestamp() if at is None else at
    return judged.select("content_hash", F.inline(events)).withColumn("processed_at", moment)
