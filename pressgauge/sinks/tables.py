"""Queue, scan, dimension and mart writers."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_candidates(candidates: DataFrame, path: str, run: str, day: str = "fetched_at") -> None:
    """Append one run's queue rows, partitioned by the day they were fetched.

    A run owns its directory, so repeating it replaces its own rows. The rows of a
    day come together before they are written, large days in several tasks, so the
    number of files follows the days and not the days times the tasks.
    """
    candidates.withColumn("queued_on", F.to_date(day)).hint("rebalance", F.col("queued_on")).write.mode("overwrite").partitionBy(
        "queued_on"
    ).option("partitionOverwriteMode", "static").parquet(f"{path}/run={run}")


def write_scans(scans: DataFrame, tactics_of, path: str, run: str) -> None:
    """Write one run's tactic rows, then its scans, so a visible scan is complete.

    Each run owns a directory per table; repeating it overwrites its own rows only.
    ``tactics_of`` derives the tactic rows from the scans.
    """
    scans.persist(StorageLevel.DISK_ONLY)
    try:
        tactics_of(scans).write.mode("overwrite").parquet(f"{path}/tactics/run={run}")
        scans.drop("tactics").write.mode("overwrite").parquet(f"{path}/scans/run={run}")
    finally:
        scans.unpersist()


def write_snapshot(snapshot: DataFrame, path: str, version: str) -> None:
    """Write a dimension snapshot under a new version; readers pick the newest one."""
    snapshot.write.mode("overwrite").parquet(f"{path}/version={version}")


def refresh_mart(mart: DataFrame, path: str) -> None:
    """Replace the weeks present in ``mart`` and leave the others as they are.

    The rows of a week come together, so each week is one file, and as many tasks
    as there are cores write weeks side by side; a mart is small, and adaptive
    execution would leave all its weeks to one task.
    """
    tasks = mart.sparkSession.sparkContext.defaultParallelism
    (
        mart.withColumn("week_start", F.to_date("week"))
        .repartition(tasks, "week_start")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("week_start")
        .parquet(path)
    )


def append_history(hashes: DataFrame, table: str, path: str, buckets: int) -> None:
    """Append held content hashes to a table laid out in sorted buckets of the hash.

    A join on the hash then reads a history of any length in place: neither a
    shuffle nor an aggregate stands between its files and the join. Choose as many
    buckets as the cluster has shuffle partitions.
    """
    (
        hashes.select("content_hash")
        .repartition(buckets, "content_hash")
        .write.bucketBy(buckets, "content_hash")
        .sortBy("content_hash")
        .option("path", path)
        .mode("append")
        .saveAsTable(table)
    )
