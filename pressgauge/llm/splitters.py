"""Sharding by sampled splitters.

A size-weighted sample of the row keys gives quantile boundaries of many fine
ranges; ranges that turn out overfull are sampled again and subdivided. Rows
are then placed range by range, so no task ever holds more than a few ranges,
and the few shards are cut from the ranges' exact cumulative sizes.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.llm.common import stored

LEAST = -(2**63)
#: How the texts of a range come by their shard, where it is not given: by the middle of the text, or of each row.
PLACED_BY_TEXT, PLACED_BY_ROW = -1, -2
KEY_SCHEMA = "array<struct<k:bigint,d:bigint,r:bigint>>"


def row_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per document: id, size, checksum and the key (k, d, r) that orders it.

    k is the text's hash, so equal texts are neighbours; d is the id; r tells
    identical rows apart. Stored, as r must not change between uses.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    doc_id = F.col(id_col).cast("long")
    narrow = docs.select(
        doc_id.alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("k"),
        F.coalesce(doc_id, F.lit(LEAST)).alias("d"),
        F.monotonically_increasing_id().alias("r"),
    )
    return stored(narrow, "shard-keys")


def _key() -> Column:
    return F.struct("k", "d", "r")


def range_of(bounds: list[tuple[int, int, int]]) -> Column:
    """How many of the sorted boundaries are at or below the row's key, by binary search."""
    if not bounds:
        return F.lit(0)
    text = "[" + ",".join(f'{{"k":{k},"d":{d},"r":{r}}}' for k, d, r in bounds) + "]"
    array = F.from_json(F.lit(text), KEY_SCHEMA)  # folded into one literal by the optimizer
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(len(bounds).bit_length()))))
    fits = lambda at, step: (at + step <= len(bounds)) & (F.get(array, at + step - 1) <= _key())
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at, step), at + step).otherwise(at))


def _cuts(sample: list[tuple[tuple[int, int, int], float]], target: float, whole_texts: bool) -> list[tuple[int, int, int]]:
    """Boundaries of ranges of about ``target`` weight each; between texts only, if ``whole_texts``."""
    groups: list[list] = []
    for key, weight in sorted(sample):
        start = (key[0], LEAST, LEAST) if whole_texts else key
        if groups and groups[-1][0] == start:
            groups[-1][1] += weight
        else:
            groups.append([start, weight])
    cuts, held = [], 0.0
    for start, weight in groups:
        if held + weight > target and held > 0:
            cuts.append(start)
            held = 0.0
        held += weight
        if whole_texts and weight >= target and start[0] < 2**63 - 1:
            cuts.append((start[0] + 1, LEAST, LEAST))  # a range of its own for a heavy text
            held = 0.0
    return cuts


def fine_ranges(keys: DataFrame, ranges: int, per_range: int, rounds: int = 8):
    """(boundaries, {range: (rows, bytes)}, {divided text: its ranges}) such that no range is overfull.

    A row weighs its share of all bytes plus its share of all rows, which bounds
    both the bytes and the rows of a range. The sample is drawn by hash, about
    ``ranges * per_range`` rows at most, whatever the table's size. It warns if
    ``rounds`` do not suffice; larger ranges make larger tasks and change nothing else.
    """
    total = keys.agg(F.count("*").alias("n"), F.sum("size").alias("b")).first()
    if not total["n"]:
        return [], {}, {}
    weight = F.col("size") / F.lit(float(total["b"])) + F.lit(1.0 / total["n"])
    target = 2.0 / ranges
    bounds: list[tuple[int, int, int]] = []
    divided: set[int] = set()
    wanted: dict[int, bool] | None = None  # overfull range -> split between texts (True) or inside one
    for turn in range(rounds):
        if turn == 0 or wanted:
            held = keys.withColumn("w", weight).withColumn("range", range_of(bounds))
            if wanted:
                held = held.where(F.col("range").isin(list(wanted)))
            draw = F.shiftrightunsigned(F.xxhash64("k", "d", "r", F.lit(turn)), 11) / F.lit(float(2**53))
            chance = F.col("w") * F.lit(per_range / target)
            drawn = held.where(draw < chance).select("k", "d", "r", "w", "range").collect()
            by_range: dict[int, list] = {}
            for row in drawn:
                by_range.setdefault(row["range"], []).append(((row["k"], row["d"], row["r"]), max(row["w"], target / per_range)))
            fresh = set(bounds)
            for at, sample in by_range.items():
                fresh.update(_cuts(sample, target, wanted is None or wanted[at]))
            bounds = sorted(fresh)
        counted = (
            keys.withColumn("w", weight)
            .groupBy(range_of(bounds).alias("range"))
            .agg(
                F.count("*").alias("n"), F.sum("size").alias("b"), F.sum("w").alias("w"),
                F.min("k").alias("low"), F.max("k").alias("high"),
            )
            .collect()
        )
        wanted = {c["range"]: c["low"] != c["high"] for c in counted if c["w"] > 2 * target and c["n"] > 1}
        divided.update(c["low"] for c in counted if c["range"] in wanted and c["low"] == c["high"])
        if not wanted:
            break
    else:
        warnings.warn(f"{len(wanted)} ranges are overfull after {rounds} rounds", stacklevel=2)
    pieces: dict[int, list[int]] = {}
    for c in sorted(counted, key=lambda c: c["range"]):
        if c["low"] == c["high"] and c["low"] in divided:
            pieces.setdefault(c["low"], []).append(c["range"])
    return bounds, {c["range"]: (c["n"], c["b"]) for c in counted}, pieces


def assign_shards(
    docs: DataFrame, shards: int = 8, ranges: int = 2048, per_range: int = 16, whole: float = 0.05, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Put every row into one of ``shards`` shards of near equal bytes.

    Returns doc_id, size, text_crc32, law ('bytes'), shard, slot (gapless from 0
    in each shard) and grown_shard (null: this law does not speak of growth).
    Equal texts share a shard, unless they hold more than ``whole`` of a shard's
    bytes, which would make shards unequal by as much; such a text may be divided
    by id. A null text counts as empty, a null id sorts first,
    repeated rows each get a slot, an empty table gives no rows, and any further
    columns are left aside.
    """
    keys = row_keys(docs, id_col, text_col)
    bounds, counts, divided = fine_ranges(keys, ranges, per_range)
    total = sum(b for _, b in counts.values())
    first_row, first_byte, n, b = [], [], 0, 0
    for at in range(len(bounds) + 1):
        first_row.append(n)
        first_byte.append(b)
        rows, size = counts.get(at, (0, 0))
        n, b = n + rows, b + size
    shard_at = lambda twice: min(shards - 1, twice * shards // (2 * max(total, 1)))
    placing = [PLACED_BY_TEXT] * (len(bounds) + 1)
    for pieces in divided.values():
        size = sum(counts[at][1] for at in pieces)
        fits = size <= whole * total / shards
        for at in pieces:
            placing[at] = shard_at(2 * first_byte[pieces[0]] + size) if fits else PLACED_BY_ROW
    longs = lambda values: F.from_json(F.lit("[" + ",".join(map(str, values)) + "]"), "array<bigint>")
    order = Window.partitionBy("range").orderBy("k", "d", "r")
    running = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    text_of = Window.partitionBy("range", "k").orderBy("d", "r").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    placed = (
        keys.withColumn("range", range_of(bounds))
        .withColumn("row", F.get(longs(first_row), F.col("range")) + F.row_number().over(order) - 1)
        .withColumn("byte", F.get(longs(first_byte), F.col("range")) + F.sum("size").over(running) - F.col("size"))
        .withColumn("placing", F.get(longs(placing), F.col("range")))
        .withColumn("alone", F.col("placing") == PLACED_BY_ROW)
        .withColumn("from", F.when(F.col("alone"), F.col("byte")).otherwise(F.min("byte").over(text_of)))
        .withColumn("to", F.when(F.col("alone"), F.col("byte") + F.col("size")).otherwise(F.max(F.col("byte") + F.col("size")).over(text_of)))
        .withColumn("shard", F.least(F.lit(shards - 1), F.expr(f"((from + to) * {shards}) div {2 * max(total, 1)}")))
        .withColumn("shard", F.when(F.col("placing") >= 0, F.col("placing")).otherwise(F.col("shard")).cast("int"))
        .select("doc_id", "size", "text_crc32", "shard", "row")
    )
    placed = stored(placed, "shard-rows")
    starts = {r["shard"]: r["row"] for r in placed.groupBy("shard").agg(F.min("row").alias("row")).collect()}
    begins = longs([starts.get(s, 0) for s in range(shards)])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("row") - F.get(begins, F.col("shard"))).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
