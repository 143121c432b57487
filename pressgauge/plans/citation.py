"""Circular citation and laundering over the graph of domains that cite each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.operators.graph import written

#: Tiers of credibility, least first.
TIERS = tuple(reversed(C.CREDIBILITY_TIERS))


def _mark(df: DataFrame) -> tuple:
    return tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first())


def _settled(start: DataFrame, step, label: str, rounds: int) -> DataFrame:
    """``step`` applied until nothing changes; every round is written, so a lost executor costs one round."""
    now, before = written(start, label), None
    for _ in range(rounds):
        mark = _mark(now)
        if mark == before:
            return now
        before, now = mark, written(step(now), label)
    raise RuntimeError(f"{label} did not settle within {rounds} rounds")


def _trim(edges: DataFrame) -> DataFrame:
    """Without edges that can be in no ring: from a domain nobody cites, or to one that cites nobody."""
    cited, citing = edges.select(F.col("target").alias("source")).distinct(), edges.select(F.col("source").alias("target")).distinct()
    return edges.join(cited, "source", "left_semi").join(citing, "target", "left_semi").select("source", "target")


def citation_rings(edges: DataFrame, rounds: int = 1000) -> DataFrame:
    """domain, ring, ring_size: strongly connected groups of two domains or more, named after their least domain.

    Forward labels give every domain the least domain that reaches it; of the domains
    with one label those that reach it back are its ring, found by backward marks.
    Rings leave the graph and the rest is labelled again. Labels are combined
    map-side, so a domain that everybody cites is one row a task.
    """
    left, rings = edges.where("source <> target").select("source", "target").distinct(), None
    for _ in range(rounds):
        left = _settled(left, _trim, "citing-edges", rounds)
        if left.isEmpty():
            break

        def forward(labels: DataFrame, graph: DataFrame = left) -> DataFrame:
            offered = graph.join(labels.withColumnRenamed("domain", "source"), "source").select(F.col("target").alias("domain"), "label")
            return labels.unionByName(offered).groupBy("domain").agg(F.min("label").alias("label"))

        nodes = left.select(F.col("source").alias("domain")).union(left.select("target")).distinct()
        labels = _settled(nodes.withColumn("label", F.col("domain")), forward, "forward-labels", rounds)
        of = lambda end: labels.select(F.col("domain").alias(end), F.col("label").alias(f"{end}_label"))
        inner = left.join(of("source"), "source").join(of("target"), "target").where("source_label = target_label")
        inner = written(inner.select("source", "target", F.col("source_label").alias("label")), "labelled-edges")

        def backward(marked: DataFrame, graph: DataFrame = inner) -> DataFrame:
            reached = graph.join(marked.select(F.col("domain").alias("target"), "label"), ["target", "label"]).select(F.col("source").alias("domain"), "label")
            return marked.unionByName(reached).distinct()

        found = _settled(labels.where("domain = label"), backward, "backward-marks", rounds)
        rings = found if rings is None else rings.unionByName(found)
        gone = found.select("domain")
        left = left.join(gone.withColumnRenamed("domain", "source"), "source", "left_anti").join(gone.withColumnRenamed("domain", "target"), "target", "left_anti")
        left = left.select("source", "target")
    else:
        raise RuntimeError(f"rings were not all found within {rounds} rounds")
    if rings is None:
        rings = left.select(F.col("source").alias("domain"), F.col("source").alias("label"))
    sizes = rings.groupBy("label").agg(F.count("*").alias("ring_size")).where("ring_size > 1")
    return rings.join(sizes, "label").select("domain", F.col("label").alias("ring"), "ring_size")


def _rank(tier: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, TIERS)), tier)


def credibility_steps(edges: DataFrame, dimension: DataFrame, rings: DataFrame) -> DataFrame:
    """Citations across tiers of credibility: source, target, their tiers, the step, and the ring both are in.

    ``step`` counts how many tiers a claim rises when ``source`` cites ``target``;
    below zero it falls. Citations within a tier, or of domains without one, are left out.
    """
    tiers = dimension.where(F.col("mbfc_credibility").isin(*TIERS)).select("domain", F.col("mbfc_credibility").alias("tier"))
    of = lambda end: tiers.select(F.col("domain").alias(end), F.col("tier").alias(f"{end}_tier"))
    placed = edges.select("source", "target").distinct().join(of("source"), "source").join(of("target"), "target").where("source_tier <> target_tier")
    ring_of = lambda end: rings.select(F.col("domain").alias(end), F.col("ring").alias(f"{end}_ring"))
    judged = placed.join(ring_of("source"), "source", "left").join(ring_of("target"), "target", "left")
    return judged.select(
        "source", "target", "source_tier", "target_tier",
        (_rank(F.col("source_tier")) - _rank(F.col("target_tier"))).cast("int").alias("step"),
        F.when(F.col("source_ring") == F.col("target_ring"), F.col("source_ring")).alias("ring"),
    )
