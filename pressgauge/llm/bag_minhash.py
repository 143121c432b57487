"""Near-duplicates by BagMinHash.

A text is the multiset of its five-word shingles. The weight axis of every shingle
is cut into ranges that double, [0, 1), [1, 2), [2, 4), ..., and each range carries a
Poisson process of its own whose points have a time, a register and a place in the
range. A shingle of weight w owns the points placed below w, so a heavy shingle
shares its first points with a lighter one and costs no more than its ranges.
A register keeps its earliest point; two texts agree in a register with probability
equal to their weighted Jaccard similarity.

Registers are banded. Of the texts in crowded buckets it is counted how much of each
none of the others has: that bounds what it can share with any of them, so a text
that is altered too much to reach the threshold leaves such buckets at once. Within a
bucket, members are compared with one of them only, a few times over; the links found
join into components, and whatever still shares buckets across components and may
reach the threshold by that bound is compared then. So no pairs inside a component are
listed, and no link between components is lost. Every link is verified exactly
on the multisets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.common import map_batches, stored

SHINGLE, THRESHOLD = 5, 0.8
REGISTERS, BANDS = 128, 32
#: The rounds compare what shares so many bands; what shares fewer is left to the last comparison.
LEAST_BANDS = 3
#: Buckets of more members have what is each member's own counted.
CROWD = 16
#: Longs of a text's parity bitmap.
PARITY = 16
_SLACK = 1e-6  # for bounds that are met exactly
_A, _B, _C, _D = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit hashes of the distinct shingles, how often each occurs).

    Words are lower-case (A-Z) and split at white space; a text of fewer words is one shingle.
    """
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = min(size, len(words))
    joined = np.full(len(words) - size + 1, size, np.uint64)
    for k in range(size):
        joined = _mix(joined * _A + hashes[k : len(hashes) - size + 1 + k])
    return np.unique(joined, return_counts=True)


def as_set(elements: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The multiset as a set: the n-th occurrence of an element is an element of its own."""
    if not len(elements) or counts.max() == 1:
        return elements
    repeated = np.repeat(elements, counts)
    nth = np.arange(len(repeated)) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.where(nth > 0, _mix(repeated + nth.astype(np.uint64) * _D), repeated)


def parities(elements: np.ndarray, longs: int = PARITY) -> np.ndarray:
    """A bitmap of ``longs`` longs: whether the number of elements that fall on each bit is odd.

    An element of one of two sets alone changes one bit between their bitmaps, so
    the bits that differ are at most as many as the elements that do.
    """
    counts = np.bincount((_mix(elements) % np.uint64(64 * longs)).astype(np.int64), minlength=64 * longs)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], registers: int = REGISTERS) -> np.ndarray:
    """Per bag the time of the earliest point in each register; empty bags stay at infinity."""
    out = np.full((len(bags), registers), np.inf)
    total = np.array([c.sum() for _, c in bags], float)
    horizon = np.where(total > 0, (np.log(registers) + 3) / np.maximum(total, 1), 0.0)
    waiting = np.flatnonzero(total > 0)
    while len(waiting):
        of = np.repeat(waiting, [len(bags[i][0]) for i in waiting])
        element = np.concatenate([bags[i][0] for i in waiting])
        count = np.concatenate([bags[i][1] for i in waiting])
        low, width, level = np.zeros(len(of)), np.ones(len(of)), 0
        while len(of):
            _points(out, of, _mix(element ^ _mix(np.full(1, level + 1, np.uint64))), count, low, width, horizon, registers)
            more = count > low + width
            of, element, count, low = of[more], element[more], count[more], (low + width)[more]
            width, level = np.maximum(low, 1.0), level + 1
        waiting = waiting[np.isinf(out[waiting]).any(axis=1)]
        out[waiting] = np.inf
        horizon[waiting] *= 2
    return out


def _points(out, of, state, count, low, width, horizon, registers) -> None:
    """Let one weight range of each element contribute its points up to the bag's horizon."""
    time, flat = np.zeros(len(of)), out.reshape(-1)
    while len(of):
        state = state + _A
        point = _mix(state)
        time = time - np.log1p(-((point >> np.uint64(11)) / float(2**53))) / (registers * width)
        alive = time < horizon[of]
        of, state, time, width, low, count, point = (x[alive] for x in (of, state, time, width, low, count, point))
        drawn = _mix(point ^ _D)
        register = (drawn % np.uint64(registers)).astype(np.int64)
        place = low + (_mix(drawn) >> np.uint64(11)) / float(2**53) * width
        owned = place < count
        np.minimum.at(flat, of[owned] * registers + register[owned], time[owned])


def band_hashes(signature: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit hash per bag and band; hashes of different bands never meet."""
    parts = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, -1)
    joined = np.broadcast_to(_mix(np.arange(1, bands + 1, dtype=np.uint64) * _D), parts.shape[:2])
    for k in range(parts.shape[2]):
        joined = _mix(joined * _A + parts[:, :, k])
    return joined.view(np.int64)


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("ka"), F.xxhash64(F.lit(1), text).alias("kb")]


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, the text's key, its number of shingles and band hashes for a table of doc_id and text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("weight", pa.int64()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                keys = list(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True))
                place = {k: i for i, k in reversed(list(enumerate(keys)))}  # equal texts are worked on once
                first = sorted(place.values())
                row_of = {keys[i]: n for n, i in enumerate(first)}
                bags = [shingles(part.column(3)[i].as_py()) for i in first]
                hashes = band_hashes(signatures(bags))
                weights = [int(c.sum()) for _, c in bags]
                rows = [row_of[k] for k in keys]
                bands = [hashes[n] if weights[n] else hashes[n][:0] for n in rows]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([weights[n] for n in rows], pa.int64()), pa.array(bands, schema.field("bands").type)], schema=schema
                )

    return map_batches(docs.select("doc_id", *_key(F.col("text")), "text"), run, "doc_id long, ka long, kb long, weight long, bands array<long>")


def _shingle_sets(texts: DataFrame) -> DataFrame:
    """id, the set form of the multiset and its bitmap, for a table of id and text."""
    schema = pa.schema([("id", pa.int64()), ("grams", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sets = [as_set(*shingles(t.as_py())) for t in part.column(1)]
                grams = pa.array([x.view(np.int64) for x in sets], schema.field("grams").type)
                bits = pa.array([parities(x) for x in sets], schema.field("bits").type)
                yield pa.RecordBatch.from_arrays([part.column(0), grams, bits], schema=schema)

    return map_batches(texts.select("id", "text"), run, "id long, grams array<long>, bits array<long>")


def _small(df: DataFrame, most: int = 300_000) -> DataFrame:
    """``df``, written already and a few numbers wide, to be broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def _few(df: DataFrame, rows: int | None = None, most: int = 300_000) -> DataFrame:
    """``df``, written already and a few numbers wide, in one partition for every ``most`` rows.

    Tables of one partition are grouped and joined without an exchange.
    """
    return df.coalesce(1 + (df.count() if rows is None else rows) // most)


def _both_ends(links: DataFrame) -> DataFrame:
    """The distinct ids of ``links`` (a, b), in the partitions that those have."""
    return links.select(F.explode(F.array("a", "b")).alias("id")).distinct()


class _Verifier:
    """Checks pairs of nodes on their multisets, each of which is computed once."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, threshold: float):
        self.docs, self.nodes, self.threshold = docs, nodes, threshold
        self.grams: DataFrame | None = None

    def sets(self, met: DataFrame) -> DataFrame:
        """id, set form and bitmap, one row each, for at least the ids of ``met``."""
        wanted = self.nodes.select("id", "doc", "ka", "kb").join(_small(met), "id", "left_semi")
        if self.grams is not None:
            wanted = wanted.join(_small(self.grams.select("id")), "id", "left_anti")
        wanted = stored(wanted, "wanted-texts")
        same = (F.col("d.ka") == F.col("w.ka")) & (F.col("d.kb") == F.col("w.kb")) & F.col("d.doc_id").eqNullSafe(F.col("w.doc"))
        texts = self.docs.select("doc_id", *_key(F.col("text")), "text").alias("d").join(_small(wanted).alias("w"), same)
        more = stored(_shingle_sets(texts.select("w.id", "d.text")), "shingle-sets")
        if not more.groupBy("id").count().where("count > 1").isEmpty():  # rows of equal text and id
            more = stored(more.dropDuplicates(["id"]), "shingle-sets")
        self.grams = more if self.grams is None else self.grams.unionByName(more)
        return self.grams

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b), none of them twice, that reach the threshold."""
        pairs = _few(stored(pairs, "candidate-pairs"))
        grams = self.sets(stored(_both_ends(pairs), "met"))
        firsts = grams.join(_small(stored(pairs.select(F.col("a").alias("id")).distinct(), "firsts")), "id", "left_semi")
        both = (
            grams.select(F.col("id").alias("b"), F.col("grams").alias("gb")).join(_small(pairs), "b")
            .join(firsts.select(F.col("id").alias("a"), F.col("grams").alias("ga")), "a")
            .withColumn("common", F.size(F.array_intersect("ga", "gb")))
        )
        reached = F.col("common") >= self.threshold * (F.size("ga") + F.size("gb") - F.col("common"))
        return stored(both.where(reached).select("a", "b"), "links")


def _often(pairs: DataFrame) -> DataFrame:
    """Pairs met in several buckets, which are the likely ones."""
    return pairs.groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_BANDS).select("a", "b")


def _joined(parts: DataFrame | None, links: DataFrame) -> DataFrame:
    """id, part after ``links`` have joined parts; ids that are in no link stand for themselves and are left out."""
    links = _few(links)
    if parts is None:
        return stored(components(links), "parts")
    old = _small(parts)
    edges = (
        links.join(old.select(F.col("id").alias("a"), F.col("part").alias("pa")), "a", "left")
        .join(old.select(F.col("id").alias("b"), F.col("part").alias("pb")), "b", "left")
        .select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
    )
    moved = stored(components(edges), "moved-parts")
    to = _small(moved)
    kept = parts.join(to.select(F.col("id").alias("part"), F.col("part").alias("new")), "part", "left")
    alone = moved.join(old.select("id"), "id", "left_anti")
    return stored(kept.select("id", F.coalesce("new", "part").alias("part")).union(alone.select("id", "part")), "parts")


def _may_reach(threshold: float, shared: Column, weight: Column, other: Column) -> Column:
    """Whether texts of ``weight`` and ``other`` shingles of which ``shared`` at most are common can reach the threshold."""
    return shared * (1 + threshold) + _SLACK >= threshold * (weight + other)


def _differ(bits: Column, others: Column) -> Column:
    """How many bits of two bitmaps differ; none are known to where a bitmap is missing."""
    parts = [F.bit_count(F.get(bits, F.lit(k)).bitwiseXOR(F.get(others, F.lit(k)))) for k in range(PARITY)]
    return F.coalesce(sum(parts[1:], parts[0]), F.lit(0))


def _buckets(nodes: DataFrame, verify: _Verifier, threshold: float) -> DataFrame:
    """h, id, weight, shared and part of the members of every bucket of several; each member is a part of its own yet.

    shared bounds what a member can have in common with any other of the bucket:
    in crowded buckets its shingles that another text of such a bucket has, else
    all. Members that cannot reach the threshold with the bucket's lightest one,
    or the lightest that they may be linked to, have no link there and are left out.
    """
    narrow = nodes.select("id", "weight", F.explode("bands").alias("h"))
    several = narrow.groupBy("h").agg(F.count("*").alias("n"), F.min("weight").alias("low")).where("n > 1")
    rows = stored(narrow.join(several, "h").select("h", "id", "weight", "n", "low"), "buckets")
    crowded = F.col("n") > CROWD
    ids = stored(rows.where(crowded).select("id").distinct(), "crowded")
    held = verify.sets(ids).join(_small(ids), "id", "left_semi")
    # a shingle of one text only is that text's own
    alone = held.select("id", F.explode("grams").alias("g")).groupBy("g").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1")
    own = stored(alone.groupBy("id").agg(F.count("*").alias("own")), "own-shingles")
    shared = F.col("weight") - F.when(crowded, F.coalesce("own", F.lit(0))).otherwise(0)
    bounded = rows.join(_small(own), "id", "left").withColumn("shared", shared)
    able = _may_reach(threshold, F.col("shared"), F.col("weight"), F.greatest(F.col("low"), F.col("weight") * threshold))
    return stored(bounded.where(able).select("h", "id", "weight", "shared", F.col("id").alias("part")), "bounded-buckets")


def _parts(docs: DataFrame, nodes: DataFrame, threshold: float, rounds: int = 8) -> DataFrame:
    """id, part: the components of all links between nodes that share enough bands, for nodes in any link.

    Each round compares the members of every bucket with one of them, first the one
    with the least of its own and then one chosen by a hash, if they are not in its
    component already; it is repeated while it still joins many. Then all pairs that
    share a bucket across components, and whose bitmaps differ little enough, are
    compared, so what the rounds left out is found.
    """
    verify = _Verifier(docs, nodes, threshold)
    rows = _buckets(nodes, verify, threshold)
    light = lambda s, t, x, y: _may_reach(threshold, F.least(s, t), x, y)
    parts: DataFrame | None = None
    n_links = 0
    for turn in range(rounds):
        own = (F.col("weight") - F.col("shared")) / F.col("weight") if turn == 0 else F.lit(0.0)
        chosen = F.min(F.struct(own.alias("own"), F.xxhash64("id", F.lit(turn)).alias("o"), "id", "part", "weight", "shared")).alias("l")
        mixed = rows.groupBy("h").agg(chosen, F.min("part").alias("low"), F.max("part").alias("high")).where("low < high")
        led = ("lead", "lead_part", "lead_weight", "lead_shared")
        mixed = stored(mixed.select("h", "l.id", "l.part", "l.weight", "l.shared").toDF("h", *led), "leaders")
        rows = stored(rows.join(_small(mixed), "h").select(*rows.columns, *led), "mixed-buckets")
        apart = rows.where(
            (F.col("part") != F.col("lead_part")) & light(F.col("shared"), F.col("lead_shared"), F.col("weight"), F.col("lead_weight"))
        )
        # the leader comes first: few of them, with many partners each
        found = verify(_often(apart.select(F.col("lead").alias("a"), F.col("id").alias("b"))))
        rows = rows.drop(*led)
        n_new = found.count()
        n_links += n_new
        if n_new or parts is None:
            parts = _joined(parts, found)
            new = _small(parts.withColumnRenamed("part", "new"))
            rows = rows.join(new, "id", "left").select("h", "id", "weight", "shared", F.coalesce("new", "id").alias("part"))
        if 300 * n_new <= n_links:
            break
    mixed = rows.groupBy("h").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low < high").select("h")
    left = stored(rows.join(mixed, "h").join(verify.grams.select("id", "bits"), "id", "left"), "mixed-buckets")
    may = light(F.col("x.shared"), F.col("y.shared"), F.col("x.weight"), F.col("y.weight"))
    # of all shingles of a pair at the threshold, so many at most are in one text alone
    alone = (1 - threshold) / (1 + threshold) * (F.col("x.weight") + F.col("y.weight")) + _SLACK
    may = may & (_differ(F.col("x.bits"), F.col("y.bits")) <= alone)
    crossing = (
        left.alias("x")
        .join(left.alias("y"), (F.col("x.h") == F.col("y.h")) & (F.col("x.part") < F.col("y.part")) & may)
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    )
    last = verify(crossing.distinct())
    return _joined(parts, last) if last.count() else parts


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """id, part: the least id of each edge's component, by alternating large and small stars.

    Every round is written to the shared folder, so no lineage grows and nothing is gathered on the driver.
    It raises if ``rounds`` do not suffice.
    """
    edges = stored(edges.select("a", "b").where("a <> b").distinct(), "component-edges")
    before = None
    for _ in range(rounds):
        mark = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        edges = _few(edges, mark["n"])
        if (mark["n"], mark["s"]) == before:
            break
        before = (mark["n"], mark["s"])
        ways = _two_ways(edges, ("a", "b"), ("b", "a"))
        least = ways.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = ways.join(least, "a").where("b > a").select(F.col("b").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # every u now has larger-to-smaller edges (u, v) only
        floor = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _two_ways(large.join(floor, "u"), ("v", "m"), ("u", "m"))
        edges = stored(small.where("a <> b").distinct(), "component-edges")
    else:
        raise RuntimeError(f"components did not settle within {rounds} rounds")
    ends = _two_ways(edges, ("a", "b"), ("b", "b"))
    return ends.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("part"))


def _two_ways(df: DataFrame, *ways: tuple[str, str]) -> DataFrame:
    """Two rows (a, b) of each row, from the named columns, in the partitions that ``df`` has."""
    ends = [F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in ways]
    return df.select(F.explode(F.array(*ends)).alias("way")).select("way.a", "way.b")


def _classes(held: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """Per text: its key, least doc_id and copies, and the class it belongs to, with the class's first text marked."""
    nodes = held.groupBy("ka", "kb").agg(
        F.min("doc_id").alias("doc"), F.count("*").alias("copies"), F.first("weight").alias("weight"), F.first("bands").alias("bands")
    )
    nodes = stored(nodes.select(F.monotonically_increasing_id().alias("id"), "*"), "text-classes")
    part_of = _parts(docs, nodes, threshold)
    placed = nodes.select("id", "ka", "kb", "doc", "copies").join(part_of, "id", "left").withColumn("part", F.coalesce("part", "id"))
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), F.col("doc"), F.col("id"))).alias("first")
    groups = placed.groupBy("part").agg(first, F.sum("copies").alias("n_class"))
    return placed.join(groups, "part").select(
        "ka", "kb", F.col("first.doc").alias("class_id"), F.col("doc").alias("copy_id"), F.col("copies").alias("n_copies"), "n_class",
        (F.col("first.id") == F.col("id")).alias("stays"),
    )


def _narrow(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, class_id, copy_id, n_copies and n_class.

    class_id is the least doc_id among the texts joined by links of the threshold
    or more, copy_id the least among equal texts; n_copies and n_class count the
    documents of either. Null and empty texts are equal to each other and like
    nothing else; null ids are left out of least ids; repeated rows each give a row;
    an empty table gives none; other columns are left aside.
    """
    narrow = _narrow(docs, id_col, text_col)
    held = stored(sketches(narrow), "sketches")
    found = _classes(held, narrow, threshold).drop("stays")
    return held.select("doc_id", "ka", "kb").join(found, ["ka", "kb"]).select("doc_id", "class_id", "copy_id", "n_copies", "n_class")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, with all its columns, without the near-duplicates of others: of each class one row with the least doc_id stays."""
    narrow = _narrow(docs, id_col, text_col)
    found = _classes(stored(sketches(narrow), "sketches"), narrow, threshold).where("stays")
    kept = found.select(F.col("ka").alias("__ka"), F.col("kb").alias("__kb"), F.col("copy_id").alias("__doc"))
    ka, kb = _key(F.coalesce(F.col(text_col), F.lit("")))
    same = (ka == F.col("__ka")) & (kb == F.col("__kb")) & F.col(id_col).cast("long").eqNullSafe(F.col("__doc"))
    return docs.join(kept, same).dropDuplicates(["__ka", "__kb"]).select(*(docs[c] for c in docs.columns))
