"""Weekly sums that a stream carries on: a base, and the few batches since.

``store``/base-N holds all sums up to turn N, ``store``/deltas/N-query-batch those of
one batch. A batch gets the next turn, and the same one when it is replayed, so it
rewrites its own delta. Now and then the deltas are folded into a new base and
removed, so the folders of a store do not grow with the number of batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pressgauge.sinks.tables import refresh_mart
from pressgauge.streaming.common import complete_folders, remove

DELTAS = 16


def _deltas(spark: SparkSession, store: str) -> dict[tuple[str, int], int]:
    """(query, batch) -> turn."""
    found = {}
    for name in complete_folders(spark, f"{store}/deltas"):
        turn, query, batch = name.split("_")
        found[query, int(batch)] = int(turn)
    return found


def _sums(spark: SparkSession, store: str, schema: StructType, deltas: dict[tuple[str, int], int]) -> tuple[int, DataFrame]:
    """(turn of the base, rows of the base and of all later deltas)."""
    base = max([int(n.removeprefix("base-")) for n in complete_folders(spark, store) if n.startswith("base-")], default=-1)
    paths = [f"{store}/base-{base}"] * (base >= 0)
    paths += [f"{store}/deltas/{t}_{q}_{b}" for (q, b), t in deltas.items() if t > base]
    return base, spark.read.schema(schema).parquet(*paths)


def fold(
    partial: DataFrame, store: str, mart: str, query: str, batch_id: int,
    merge: Callable[[DataFrame], DataFrame], publish: Callable[[DataFrame], DataFrame], most: int = DELTAS,
) -> None:
    """Add a batch's sums (with a ``week``) to the store and publish the weeks it touches.

    The sums of other weeks are pruned by the week column and written nowhere. Names
    of touched weeks are collected, which the calendar bounds.
    """
    spark, schema = partial.sparkSession, partial.schema
    deltas = _deltas(spark, store)
    base, _ = (-1, None) if not deltas else _sums(spark, store, schema, deltas)
    turn = deltas.get((query, batch_id), max([base, *deltas.values()]) + 1)
    own = f"{store}/deltas/{turn}_{query}_{batch_id}"
    partial.repartition(1).sortWithinPartitions("week").write.mode("overwrite").parquet(own)  # summed up: a row a mart key
    touched = [r["week"] for r in spark.read.schema(schema).parquet(own).select("week").distinct().collect()]
    deltas[query, batch_id] = turn
    base, sums = _sums(spark, store, schema, deltas)
    if touched:
        refresh_mart(publish(sums.where(F.col("week").isin(touched))), mart)
    if len(deltas) > most:
        # the newest delta of every query may yet be replayed, and stays
        newest = {q: max(b for p, b in deltas if p == q) for q, _ in deltas}
        last = min(t for (q, b), t in deltas.items() if b == newest[q])
        old = {k: t for k, t in deltas.items() if t < last}
        if any(t > base for t in old.values()):
            _, before = _sums(spark, store, schema, old)
            merge(before).write.mode("overwrite").parquet(f"{store}/base-{last - 1}")
            for (q, b), t in old.items():
                remove(spark, f"{store}/deltas/{t}_{q}_{b}")
            if base >= 0:
                remove(spark, f"{store}/base-{base}")
