"""First-wins selection and suppression of known content."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Total ingest order: run, then phase (feeds, discovery, ads), feed and item.
ORDER = ("fetched_at", "phase", "feed_ordinal", "item_pos")


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], k: int) -> DataFrame:
    """The first ``k`` rows per key in the given order.

    Catalyst turns the rank filter into a group limit before the exchange, so
    a task ships at most ``k`` rows of a key however hot that key is.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in a total order, unlike an arbitrary duplicate drop."""
    return top_k(df, keys, order, 1)


def with_reason(rows: DataFrame, queued: DataFrame | None, scanned: DataFrame) -> DataFrame:
    """Adds ``reason``: why a row's content is already held (queued comes before scanned), NULL if it is not.

    Histories are only asked whether they hold a hash, so they are neither
    aggregated nor need they be unique. For rows that are few per hash; hot
    hashes are better served by ``suppress_known``.
    """

    def held(history: DataFrame) -> Column:
        # the row's hash goes by another name, or it would be taken from the history itself
        return history.select("content_hash").where(F.col("content_hash") == F.col("_row_hash").outer()).exists()

    known = rows.withColumn("_row_hash", F.col("content_hash")).withColumn("_scanned", held(scanned))
    reason = F.when(F.col("_scanned"), "scanned")
    if queued is not None:
        known = known.withColumn("_queued", held(queued))
        reason = F.when(F.col("_queued"), "queued").otherwise(reason)
    return known.withColumn("reason", reason).drop("_scanned", "_queued", "_row_hash")


def not_held(rows: DataFrame, *histories: DataFrame | None) -> DataFrame:
    """Rows whose content none of the histories holds."""
    for history in histories:
        if history is not None:
            rows = rows.join(history.select("content_hash"), "content_hash", "left_anti")
    return rows


def suppress_known(
    candidates: DataFrame, queued: DataFrame | None, scanned: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Split candidates into new ones and skipped ones with a ``reason``.

    Only semi- and anti-joins: a history is read for its hashes, is not aggregated,
    and, if it was written by ``append_history``, is not shuffled either. Candidates
    are the streamed side, so a hot hash is a skew that adaptive execution splits.
    """
    new = not_held(candidates, queued, scanned)
    skipped = not_held(candidates, queued).join(scanned.select("content_hash"), "content_hash", "left_semi").withColumn("reason", F.lit("scanned"))
    if queued is not None:
        in_queue = candidates.join(queued.select("content_hash"), "content_hash", "left_semi").withColumn("reason", F.lit("queued"))
        skipped = in_queue.unionByName(skipped)
    return new, skipped


def run_outcomes(candidates: DataFrame, queued: DataFrame, scanned: DataFrame) -> DataFrame:
    """Outcome counts per source type for one run: queued, or skipped and why.

    Copies of one text are counted per hash before the join, so neither the
    exchange nor the join sees more than one row per (hash, source type) and
    task. Of the copies of a new hash the first is queued; the others find it
    in the queue. Rows without a hash never became candidates and are counted
    under the outcome in their ``lost`` column, where there is one.
    """
    lost = F.col("lost") if "lost" in candidates.columns else F.lit(None).cast("string")
    per_type = candidates.groupBy("content_hash", "source_type", lost.alias("lost")).agg(
        F.count("*").alias("copies"), F.min(F.struct(*ORDER)).alias("first_seen")
    )
    # at most one row per source type and hash is left, so this window stays tiny
    earliest = F.min("first_seen").over(Window.partitionBy("content_hash"))
    judged = with_reason(per_type.withColumn("earliest", earliest), queued, scanned)
    is_first = (
        F.col("content_hash").isNotNull() & F.col("reason").isNull() & (F.col("first_seen") == F.col("earliest"))
    )
    accepted = F.when(is_first, 1).otherwise(0)
    reason = F.when(F.col("lost").isNull(), F.coalesce("reason", F.lit("queued")))
    return (
        judged.select(
            "source_type",
            F.inline(
                F.array(
                    F.struct(
                        F.lit("queued").alias("outcome"),
                        F.lit(None).cast("string").alias("skip_reason"),
                        accepted.cast("long").alias("items"),
                    ),
                    F.struct(
                        F.coalesce("lost", F.lit("skipped")).alias("outcome"),
                        reason.alias("skip_reason"),
                        (F.col("copies") - accepted).alias("items"),
                    ),
                )
            ),
        )
        .filter("items > 0")
        .groupBy("source_type", "outcome", "skip_reason")
        .agg(F.sum("items").alias("items"))
    )
