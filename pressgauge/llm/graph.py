"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, rounds: int = 100) -> DataFrame:
    """id, part: the least id that each id of ``edges`` (a, b) reaches; ids without a link are not listed.

    Every round ties all larger neighbours of a node to its least one, and then
    all smaller ones, so the depth of what is left falls by a factor a round. Rows
    are written to the shared folder each round: no lineage grows, and nothing but
    a count and a checksum reaches the driver. It raises if ``rounds`` do not suffice.
    """
    down = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    down = stored(down, "links")
    before = _state(down)
    for _ in range(rounds):
        ways = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = ways.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        larger = down.select(F.col("b").alias("a"), F.col("a").alias("v")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b"))
        larger = larger.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        floor = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(floor, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = stored(smaller.unionByName(floor.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(down)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    parts = down.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("part"))
    roots = down.select(F.col("b").alias("id"), F.col("b").alias("part")).distinct()
    return parts.unionByName(roots.join(parts, "id", "left_anti"))
