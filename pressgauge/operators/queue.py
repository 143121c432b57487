"""The work queue as an append-only event log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge import constants as C


def latest_status(events: DataFrame) -> DataFrame:
    """Last status event per item; combined map-side, so long histories stay cheap."""
    return (
        events.groupBy("item_id")
        .agg(F.max_by(F.struct("status", "processed_at", "error_message", "seq"), "seq").alias("last"))
        .select("item_id", "last.*")
    )


def current_queue(queue: DataFrame, events: DataFrame) -> DataFrame:
    """Queue items with their current status; items without events keep the initial one."""
    last = latest_status(events).select("item_id", F.col("status").alias("last_status"))
    return (
        queue.join(last, "item_id", "left")
        .withColumn("status", F.coalesce("last_status", "status"))
        .drop("last_status")
    )


def queue_depth(current: DataFrame) -> DataFrame:
    """Number of items still pending."""
    return current.agg(F.count_if(F.col("status") == "pending").alias("pending_items"))


def claim_batch(queue: DataFrame, n: int = C.CLAIM_LIMIT) -> DataFrame:
    """Oldest pending items; items without a queue time come last, ties by hash."""
    return (
        queue.filter("status = 'pending'")
        .orderBy(F.col("queued_at").asc_nulls_last(), F.col("content_hash"))
        .limit(n)
    )


def analysis_summary(claimed: DataFrame, current: DataFrame) -> DataFrame:
    """Counters of one analysis run over the claimed items' final statuses, with depth and cost."""
    depth = queue_depth(current).scalar()
    return (
        claimed.agg(
            F.count("*").alias("processed"),
            F.count_if(F.col("status") == "done").alias("scanned"),
            F.count_if(F.col("status") == "error").alias("errors"),
        )
        .withColumn("est_cost", F.round(F.col("scanned") * C.COST_PER_SCAN, 3))
        .withColumn("still_pending", depth)
    )
