"""Candidate ingest, status machine, scan sinks and incremental marts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from pressgauge.operators.dedup import ORDER
from pressgauge.plans import marts
from pressgauge.plans.analyse import scans_from_responses, tactics_from_scans
from pressgauge.sources.responses import parse_responses
from pressgauge.streaming.common import batch_dir, ensure_table, exists, first_sightings, start, stored_rows
from pressgauge.streaming.partials import fold


def stream_candidates(stream: DataFrame, path: str, checkpoint: str, order=ORDER) -> StreamingQuery:
    """Continuous ingest with one row per content hash for the life of the sink.

    The first copy in the first batch that has a text wins. Known hashes are keyed
    state on disk, so a batch costs what the batch holds, however long the history
    is. Candidates are narrow rows; bodies are stored by their hash elsewhere.
    """
    schema, spark = stream.schema, stream.sparkSession
    ensure_table(spark, schema, path)
    new = first_sightings(stream, ["content_hash"], order, stored_rows(spark, schema, path), checkpoint)

    def handle(batch: DataFrame, batch_id: int, query: str) -> None:
        batch.write.mode("overwrite").parquet(batch_dir(path, query, batch_id))

    return start(new, handle, checkpoint, mode="update")


def stream_status(events: DataFrame, queue: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append given status events of items the queue knows to the event log.

    ``queue`` is a snapshot with one row per item. The inner join leaves Spark
    free to broadcast whichever side is small, which mostly is the batch.
    """
    known = queue.select("item_id")

    def handle(batch: DataFrame, batch_id: int, query: str) -> None:
        batch.join(known, "item_id").select(*batch.columns).write.mode("overwrite").parquet(batch_dir(path, query, batch_id))

    return start(events, handle, checkpoint)


STUCK = "no response in time"
TRANSITIONS = "content_hash string, step int, status string, error_message string, processed_micros long, rejected string"


def status_machine(stuck_seconds: int) -> StatefulProcessor:
    """One item's life: pending, processing once claimed, then done or error; what breaks that order is rejected.

    An item that stays in ``processing`` for ``stuck_seconds`` of event time goes
    back to pending, so that it can be claimed again. A rejected signal moves nothing.
    Rows go in and out as they are: a pandas frame an item would cost more than all else.
    """
    Move = Row("content_hash", "step", "status", "error_message", "processed_micros", "rejected")

    class Item(StatefulProcessor):
        def init(self, handle) -> None:
            self.handle = handle
            self.item = handle.getValueState("item", "status string, steps int, due long, timer long")

        def handleInputRows(self, key, rows, timerValues):
            status, steps, due, timer = self.item.get() or ("pending", 0, 0, None)
            out = []

            def move(target, error, micros):
                nonlocal status, steps
                status, steps = target, steps + 1
                out.append(Move(key[0], steps, status, error, micros, None))

            signals = sorted(((r.micros, r.kind, r.error_message) for r in rows), key=lambda r: r[:2])  # a claim comes before a response of the same moment
            for micros, kind, error in signals:
                if status == "processing" and micros > due * 1000:
                    move("pending", STUCK, due * 1000)  # the timer would have gone off in between, whatever batch the signal came with
                target = "processing" if kind == "claim" else "done" if error is None else "error"
                if status == ("pending" if kind == "claim" else "processing"):
                    move(target, error, micros)
                    due = micros // 1000 + stuck_seconds * 1000
                else:
                    out.append(Move(key[0], None, target, error, micros, f"{kind} while {status}"))
            wanted = max(due, timerValues.getCurrentWatermarkInMs() + 1) if status == "processing" else None
            if wanted != timer:
                if timer is not None:
                    self.handle.deleteTimer(timer)
                if wanted is not None:
                    self.handle.registerTimer(wanted)
            self.item.update((status, steps, due, wanted))
            yield from out

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
            _, steps, due, _ = self.item.get()
            self.item.update(("pending", steps + 1, due, None))
            yield Move(key[0], steps + 1, "pending", STUCK, due * 1000, None)

        def close(self) -> None:
            pass

    return Item()


def stream_transitions(claims: DataFrame, responses: DataFrame, path: str, checkpoint: str, stuck_seconds: int = 3600, late: str = "10 minutes") -> StreamingQuery:
    """The status log that analysing gives, derived from claims and responses as they arrive.

    ``claims`` has content_hash and at; ``responses`` also has body. Transitions go
    to ``path``/events, signals that no item in that state can receive to
    ``path``/rejected. State is one small row per item; ``late`` bounds how far
    behind the newest moment a signal may come.
    """
    good = parse_responses(responses).select("content_hash", "at", F.lit("response").alias("kind"), "error_message")
    claimed = claims.select("content_hash", "at", F.lit("claim").alias("kind"), F.lit(None).cast("string").alias("error_message"))
    signals = claimed.unionByName(good).withWatermark("at", late).withColumn("micros", F.unix_micros("at"))
    moved = signals.groupBy("content_hash").transformWithState(status_machine(stuck_seconds), TRANSITIONS, "append", "EventTime")
    moved = moved.select("content_hash", "step", "status", "error_message", F.timestamp_micros("processed_micros").alias("processed_at"), "rejected")

    def handle(batch: DataFrame, batch_id: int, query: str) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)  # narrow rows; else the state would be stepped twice
        try:
            batch.where("rejected is null").drop("rejected").write.mode("overwrite").parquet(batch_dir(f"{path}/events", query, batch_id))
            batch.where("rejected is not null").drop("step").write.mode("overwrite").parquet(batch_dir(f"{path}/rejected", query, batch_id))
        finally:
            batch.unpersist()

    return start(moved, handle, checkpoint)


def stream_scans(
    responses: DataFrame, path: str, checkpoint: str, items: DataFrame | None = None, dimension: DataFrame | None = None, scanned_at: Column | None = None
) -> StreamingQuery:
    """Two sinks from one stream: tactic rows first, then the scans they belong to.

    With ``items`` and ``dimension`` a scan has the item's, credibility and
    provenance columns, as in a batch run; without, only what the response says.
    Failed responses give no scan; ``stream_transitions`` tells of them. A scan that
    a query of another checkpoint wrote already is not written again.
    """

    def parsed(batch: DataFrame) -> DataFrame:
        if items is None:
            return parse_responses(batch).filter("error_message is null").drop("error_message")
        return scans_from_responses(items, batch, dimension, scanned_at)

    def handle(batch: DataFrame, batch_id: int, query: str) -> None:
        spark, good = batch.sparkSession, parsed(batch)
        if exists(spark, f"{path}/scans"):
            elsewhere = spark.read.schema("content_hash string, query_id string, batch_id long").parquet(f"{path}/scans")
            others = elsewhere.where(F.col("query_id") != query).select("content_hash")
            good = good.join(others, "content_hash", "left_anti")
        good = good.persist(StorageLevel.DISK_ONLY)
        try:
            tactics_from_scans(good).write.mode("overwrite").parquet(batch_dir(f"{path}/tactics", query, batch_id))
            good.drop("tactics").write.mode("overwrite").parquet(batch_dir(f"{path}/scans", query, batch_id))
        finally:
            good.unpersist()

    return start(responses, handle, checkpoint)


def stream_weekly(scans: DataFrame, store: str, mart: str, checkpoint: str, key: str = "scan_id") -> StreamingQuery:
    """Keep the weekly domain mart current with every batch of scans.

    A scan counts once for the life of the store, whatever checkpoint reads it. The
    store holds partial sums, one row per mart key, so scans are never read again.
    """
    spark, counted = scans.sparkSession, f"{store}/counted"
    ids = scans.select(key).schema
    ensure_table(spark, ids, counted)
    columns = [key, "scan_status", "in_distribution", "spi_score", "scanned_at", *(c for c in marts.DOMAIN_KEYS if c != "week")]
    new = first_sightings(scans.select(*columns), [key], ["scanned_at"], stored_rows(spark, ids, counted), checkpoint)

    def handle(batch: DataFrame, batch_id: int, query: str) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            fold(marts.domain_partials(batch), store, mart, query, batch_id, marts.add_domain_partials, marts.merge_domain_partials)
            batch.select(key).write.mode("overwrite").parquet(batch_dir(counted, query, batch_id))
        finally:
            batch.unpersist()

    return start(new, handle, checkpoint, mode="update")


def stream_tactics(scans: DataFrame, tactics: DataFrame, store: str, mart: str, checkpoint: str, late: str = "1 day") -> StreamingQuery:
    """Keep the weekly tactic mart current: tactic rows meet their scans in event time.

    ``scans`` has scanned_at, ``tactics`` has detected_at; both may arrive in any
    order within ``late`` of each other, and the join's state is dropped behind the
    watermark. ``mart`` takes the weeks a batch touches.
    """
    facts = scans.select("scan_id", "scan_status", "in_distribution", "spi_score", "region", "media_class", "scanned_at").withWatermark("scanned_at", late)
    rows = tactics.select(F.col("scan_id").alias("of_scan"), "tactic_code", "tactic_label", "taxonomy_version", "detected_at").withWatermark("detected_at", late)
    span = F.expr(f"interval {late}")
    meets = (F.col("of_scan") == F.col("scan_id")) & (F.col("detected_at") >= F.col("scanned_at") - span) & (F.col("detected_at") <= F.col("scanned_at") + span)

    def handle(batch: DataFrame, batch_id: int, query: str) -> None:
        fold(marts.tactic_partials(batch), store, mart, query, batch_id, marts.add_tactic_partials, marts.merge_tactic_partials)

    return start(marts.in_scope(facts).join(rows, meets), handle, checkpoint)
