"""Plain table readers; every one is a Parquet scan Catalyst can prune."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw page sources ``(url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def read_ad_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Text nodes of ad cards, as ``ads.assemble_ads`` takes them; ``fetched_at`` names the run."""
    return spark.read.parquet(path).select(
        "fetched_at", "term", "country", "container_pos", "node_pos", "text", "advertiser_name"
    )


def read_queue(spark: SparkSession, path: str) -> DataFrame:
    """The work queue, all statuses."""
    return spark.read.parquet(path)


def pending(queue: DataFrame) -> DataFrame:
    """Queue rows nobody has claimed."""
    return queue.filter("status = 'pending'")
