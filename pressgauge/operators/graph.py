"""Groups of things that links hold together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.session import scratch_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: no lineage, no second run."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, rounds: int = 100) -> DataFrame:
    """id, part: the least id each id of ``links`` (a, b) reaches; ids without a link are not listed.

    A round hangs every larger neighbour of a node on its least neighbour, then
    every smaller one, so paths shrink by a factor a round and a star's centre is
    never gathered. It raises when ``rounds`` do not suffice.
    """
    down = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = _state(down)
    for _ in range(rounds):
        # rows (a, b) of ``down`` point from the larger to the smaller id
        least = down.unionByName(down.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        hung = down.join(least.withColumnRenamed("a", "b"), "b").select("a", F.col("m").alias("b"))
        hung = hung.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        floor = hung.groupBy("a").agg(F.min("b").alias("m"))
        rest = hung.join(floor, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        down = written(rest.unionByName(floor.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(down)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    parts = down.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("part"))
    roots = down.select(F.col("b").alias("id"), F.col("b").alias("part")).distinct()
    return parts.unionByName(roots.join(parts, "id", "left_anti"))


def extend_components(known: DataFrame, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """id, part of ``known`` carried on by new ``links`` and ``nodes`` (id).

    Links are first drawn between the labels their ends have already, so work grows
    with the new links. A label changes only where a link ties it to a smaller one.
    """
    labels = known.unionByName(nodes.join(known, "id", "left_anti").select("id", F.col("id").alias("part")))
    labels = written(labels, "labels")
    ends = (
        links.join(labels.select(F.col("id").alias("a"), F.col("part").alias("pa")), "a")
        .join(labels.select(F.col("id").alias("b"), F.col("part").alias("pb")), "b")
        .select(F.col("pa").alias("a"), F.col("pb").alias("b"))
    )
    moved = components(ends).select(F.col("id").alias("part"), F.col("part").alias("new"))
    return labels.join(moved, "part", "left").select("id", F.coalesce("new", "part").alias("part"))
