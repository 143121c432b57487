"""Shared pieces of the streaming jobs: sinks keyed by query and batch, and lifetime first sightings."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id Spark gave the query of this checkpoint; it is written before the first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def start(
    stream: DataFrame,
    handle: Callable[[DataFrame, int, str], None],
    checkpoint: str,
    available_now: bool = True,
    mode: str = "append",
) -> StreamingQuery:
    """Run ``handle(batch, batch_id, query_id)`` on every micro-batch.

    Batch ids begin at 0 under a new checkpoint; with the query's id beside them
    two runs never write to one place, and a replayed batch always does.
    """
    spark, ids = stream.sparkSession, []

    def run(batch: DataFrame, batch_id: int) -> None:
        if not ids:
            ids.append(query_id(batch.sparkSession, checkpoint))
        handle(batch, batch_id, ids[0])

    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).outputMode(mode)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def batch_dir(path: str, query: str, batch_id: int) -> str:
    return f"{path}/query_id={query}/batch_id={batch_id}"


def ensure_table(spark: SparkSession, schema: StructType, path: str) -> None:
    """Give an empty sink a schema: the query ``none`` has no rows."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(batch_dir(path, "none", -1))


def stored_rows(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """All rows of a sink, with the query and batch that wrote them."""
    return spark.read.schema(StructType(list(schema.fields)).add("query_id", "string").add("batch_id", "long")).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists, in whatever store it lies."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def complete_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path`` whose write was finished."""
    if not exists(spark, path):
        return []
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [s.getPath().getName() for s in hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(hadoop) if s.isDirectory()]
    return [n for n in names if exists(spark, f"{path}/{n}/_SUCCESS")]


def remove(spark: SparkSession, path: str) -> None:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def first_sightings(stream: DataFrame, keys: Sequence[str], order: Sequence[str], known: DataFrame, checkpoint: str) -> DataFrame:
    """The rows of a stream that are the first of their key for life, to be run in ``update`` mode.

    The state is keyed by ``keys`` and lives in RocksDB, so a batch reads and
    writes the keys it has and no history. A key's first batch wins, and in it the
    first row in ``order``; copies are combined map-side, so a hot key is one row a
    task. ``known`` (the keys a sink has already) is written once per checkpoint
    and enters the state with the first batch, so a new checkpoint over an old sink
    repeats nothing. Rows must be orderable and narrow, as the state keeps one a key.
    """
    spark, seed = stream.sparkSession, f"{checkpoint}-known"
    shape = StructType([f for f in stream.schema.fields if f.name in keys])
    if not exists(spark, f"{seed}/_SUCCESS"):
        known.select(*shape.names).distinct().write.mode("overwrite").parquet(seed)
    old = spark.readStream.schema(shape).parquet(seed)
    kinds = dict(stream.dtypes)
    place = [F.col(c).alias(f"o{i}") for i, c in enumerate(order)]
    nowhere = [F.lit(None).cast(kinds[c]).alias(f"o{i}") for i, c in enumerate(order)]
    at = F.current_timestamp()  # one moment for all rows of a batch, kept in the offset log for replays
    fresh = stream.select(*keys, F.struct(at.alias("at"), F.lit(1).alias("rank"), *place).alias("seen"), F.struct(*stream.columns).alias("row"))
    held = old.select(*keys, F.struct(at.alias("at"), F.lit(0).alias("rank"), *nowhere).alias("seen"), F.lit(None).cast(stream.schema).alias("row"))
    first = fresh.unionByName(held).groupBy(*keys).agg(F.min("seen").alias("first"), F.max("seen.at").alias("last"), F.min_by("row", "seen").alias("row"))
    return first.where((F.col("first.rank") == 1) & (F.col("first.at") == F.col("last"))).select("row.*")
