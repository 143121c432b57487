"""Source divergence audit on a K-squared quadtree of the group-term count matrix.

The rows of a language's matrix are its sources, the columns its kept terms, and
almost all cells are zero. A source's zero cells all have one and the same p, so
for a pair of sources the matrix is first priced as if no cell were counted in
both: all-zero quadrants cost one product, and cells counted in one of the two
come from that source's histogram of p. What that leaves out are cells counted
in both. They are found in stripes of columns, each held as a tree whose nodes
split into K x K quadrants down to small leaves; all-zero quadrants have no node.
Pairs of quadrants in the same columns are followed downwards together, and the
leaves they end in are compared cell by cell, which corrects the first price.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.llm.common import map_batches, ship, stored

LEAST_DOCS, TOP_TERMS = 3, 200
#: Counted cells a stripe of columns holds on average, and terms a task counts before it passes them on.
STRIPE_CELLS, HELD_TERMS = 1 << 16, 1 << 18
#: Every node has K x K quadrants; leaves are K x K cells.
K, BITS = 4, 2
_PAIRS = 1 << 14

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters A-Z (lower-cased) and non-ASCII characters of a UTF-8 text."""
    return text.translate(_LETTERS).split()


def _partial_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term with occurrences and documents, counted within each task."""
    names = ["lang", "source", "term", "count", "docs"]
    schema = pa.schema(list(zip(names, [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()], strict=True)))

    def passed_on(held) -> Iterator[pa.RecordBatch]:
        for (lang, source), (counts, docs_with) in held.items():
            terms = list(counts)
            for at in range(0, len(terms), 50_000):
                part = terms[at : at + 50_000]
                columns = [[lang] * len(part), [source] * len(part), part, [counts[t] for t in part], [docs_with[t] for t in part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 250):
                for lang, source, text in zip(*(c.to_pylist() for c in batch.slice(at, 250).columns), strict=True):
                    if terms := terms_of(text):
                        counts, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                        counts.update(terms)
                        docs_with.update(set(terms))
                if sum(len(c) for c, _ in held.values()) > HELD_TERMS:
                    yield from passed_on(held)
                    held = {}
        yield from passed_on(held)

    counted = map_batches(docs.select("lang", "source", F.col("text").cast("binary")), run, "lang string, source string, term binary, count long, docs long")
    return counted.withColumn("term", F.col("term").cast("string"))


def _share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (n + v)), exactly; null where nothing is kept."""
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.when(v > 0, 1 + F.call_function("div", above, (n + v).cast("decimal(20,0)")))


def _gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)"""
    return F.call_function("div", (p - q) * (p - q), q)


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


class QuadTree:
    """The counted cells of a matrix: per level the sorted codes (column block, row block) of its nonzero quadrants."""

    def __init__(self, row: np.ndarray, col: np.ndarray, p: np.ndarray):
        height = 1
        while K**height <= max(int(row.max()), int(col.max())):
            height += 1
        self.levels, self.parts = [], []
        for level in range(1, height + 1):  # quadrants of K^level cells a side, leaves first
            codes = (col >> (BITS * level) << 32) | (row >> (BITS * level))
            self.levels.append(np.unique(codes))
        for lower, upper in zip(self.levels, self.levels[1:], strict=False):
            above = (lower >> 32 >> BITS << 32) | ((lower & 0xFFFFFFFF) >> BITS)
            slot = np.searchsorted(upper, above) * K + (lower >> 32 & (K - 1))  # parent and column quarter
            order = np.argsort(slot, kind="stable")
            self.parts.append((order, np.searchsorted(slot[order], np.arange(len(upper) * K + 1))))
        leaf = np.searchsorted(self.levels[0], (col >> BITS << 32) | (row >> BITS))
        self.cells = np.zeros((len(self.levels[0]), K, K), np.int64)
        self.cells[leaf, row & (K - 1), col & (K - 1)] = p
        self.leaf_rows = (self.levels[0] & 0xFFFFFFFF).astype(np.int64) * K

    def joint_leaves(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of leaves over the same columns, by following pairs of nodes from the root, a bounded number at a time."""
        todo = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, x, y = todo.pop()
            if len(x) > _PAIRS:
                todo += [(level, x[at : at + _PAIRS], y[at : at + _PAIRS]) for at in range(0, len(x), _PAIRS)]
            elif level == 0:
                yield x, y
            else:
                order, start = self.parts[level - 1]
                sx, sy = ((n[:, None] * K + np.arange(K)).ravel() for n in (x, y))
                nx, ny = start[sx + 1] - start[sx], start[sy + 1] - start[sy]
                of = np.repeat(np.arange(len(sx)), nx * ny)
                nth = np.arange(len(of)) - np.repeat(np.cumsum(nx * ny) - nx * ny, nx * ny)
                todo.append((level - 1, order[start[sx][of] + nth // ny[of]], order[start[sy][of] + nth % ny[of]]))


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    found, first = np.unique(keys[order], return_index=True)
    return found, np.add.reduceat(values[order], first) if len(first) else values[:0]


def joint_corrections(row: np.ndarray, col: np.ndarray, p: np.ndarray, zero: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, sum) over the cells counted in rows a and b: their gap, less what the first price took for it.

    ``zero`` is each row's p of an uncounted cell.
    """
    rows = len(zero)
    tree = QuadTree(row, col, p)
    wide = np.ones(-(-rows // K) * K, np.int64)
    wide[:rows] = zero
    keys, sums, held = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    for x, y in tree.joint_leaves():
        pa_, pb = tree.cells[x][:, :, None, :], tree.cells[y][:, None, :, :]
        both = (pa_ > 0) & (pb > 0)
        ra, rb = tree.leaf_rows[x][:, None] + np.arange(K), tree.leaf_rows[y][:, None] + np.arange(K)
        a, b = (np.broadcast_to(v, both.shape)[both] for v in (pa_, pb))
        za, zb = (np.broadcast_to(v, both.shape)[both] for v in (wide[ra][:, :, None, None], wide[rb][:, None, :, None]))
        cells = np.zeros(both.shape, np.int64)
        cells[both] = gap(a, b) - gap(a, zb) - gap(za, b) + gap(za, zb)
        met = both.any(axis=3)
        key = ra[:, :, None] * rows + rb[:, None, :]
        found = _summed(key[met], cells.sum(axis=3)[met])
        keys.append(found[0])
        sums.append(found[1])
        held += len(found[0])
        if held > 1 << 20:
            found = _summed(np.concatenate(keys), np.concatenate(sums))
            keys, sums, held = [found[0]], [found[1]], 0
    key, total = _summed(np.concatenate(keys), np.concatenate(sums))
    return key // rows, key % rows, total


def _stripe(table: pa.Table) -> pa.Table:
    """Corrections of one stripe of columns, between the sources counted in it."""
    group, row = np.unique(table.column("gid").to_numpy(), return_inverse=True)
    zero = np.ones(len(group), np.int64)
    zero[row] = table.column("zero").to_numpy()
    col = table.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    a, b, total = joint_corrections(row.astype(np.int64), col, table.column("p").to_numpy(), zero)
    apart = a != b
    return pa.table({"a": group[a[apart]], "b": group[b[apart]], "value": total[apart]})


def _kept_cells(docs: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, term, count, the term's count in its language, and a mark on one row of each (lang, term)."""
    cells = _partial_counts(docs).groupBy("lang", "source", "term").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    seen = cells.withColumns(
        {"lang_docs": F.sum("docs").over(of_term), "lang_count": F.sum("count").over(of_term), "lead": F.col("source") == F.min("source").over(of_term)}
    )
    return stored(seen.where(F.col("lang_docs") >= least_docs).select("lang", "source", "term", "count", "lang_count", "lead"), "kept-cells")


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """How far the sources of each language lie apart, and which terms set each source off from its language.

    Returns lang, source, part, item, value and rank. Part ``pair`` ranks the
    other sources of the language by the divergence from this one, all of them;
    part ``term`` the ``top_terms`` terms that this source uses more than its
    language. Null texts, languages and sources count as empty; a source without
    terms still is in ``pair``; a language that keeps no term has pairs of value 0;
    each row counts as a document, repeated or not; ties go by item; an empty
    table gives no rows; further columns are left aside.
    """
    filled = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    kept = _kept_cells(filled, least_docs)
    langs = kept.groupBy("lang").agg(F.sum("count").alias("lang_n"), F.count_if("lead").alias("v"), F.count("*").alias("cells"))
    totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    none = F.lit(0).cast("long")
    groups = (
        filled.groupBy("lang", "source").agg(F.count("*").alias("rows"))
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *(F.coalesce(F.col(c), none).alias(c) for c in ("n", "lang_n", "v", "cells")))
        .withColumn("zero", _share(none, F.col("n"), F.col("v")))
    )
    groups = stored(groups.select(F.monotonically_increasing_id().alias("gid"), "*"), "matrix-rows")
    cells = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "gid", "term", "zero", _share(F.col("count"), F.col("n"), F.col("v")).alias("p"),
        _share(F.col("lang_count"), F.col("lang_n"), F.col("v")).alias("q"),
        F.pmod(F.xxhash64("term"), F.ceil(F.col("cells") / STRIPE_CELLS)).alias("stripe"),
    )
    cells = stored(cells, "matrix-cells")
    return _pairs(cells, groups).unionByName(_terms(cells, top_terms))


def _ranked(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return df.withColumn("rank", F.row_number().over(order))


def _terms(cells: DataFrame, top: int) -> DataFrame:
    found = cells.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _gap(F.col("p"), F.col("q")).alias("value"))
    return _ranked(found).where(F.col("rank") <= top)


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    rows = groups.select("lang", "gid", "zero", "v")
    others = rows.select("lang", F.col("gid").alias("other"), F.col("zero").alias("other_zero"))
    z, o, p = F.col("zero"), F.col("other_zero"), F.col("p")
    apart = F.col("gid") != F.col("other")
    # as if no cell were counted in either: one product for all columns
    empty = rows.join(others, "lang").where(apart).select(F.col("gid").alias("a"), F.col("other").alias("b"), F.coalesce(F.col("v") * _gap(z, o), F.lit(0)).alias("value"))
    # cells counted in one of the two, by that row's histogram of p
    histogram = cells.groupBy("lang", "gid", "zero", "p").agg(F.count("*").alias("n"))
    ways = F.array(
        F.struct(F.col("gid").alias("a"), F.col("other").alias("b"), (F.col("n") * (_gap(p, o) - _gap(z, o))).alias("value")),
        F.struct(F.col("other").alias("a"), F.col("gid").alias("b"), (F.col("n") * (_gap(o, p) - _gap(o, z))).alias("value")),
    )
    single = histogram.join(others, "lang").where(apart).select(F.inline(ways))
    ship(cells.sparkSession)
    both = cells.select("lang", "stripe", "gid", "zero", "term", "p").groupBy("lang", "stripe").applyInArrow(_stripe, "a long, b long, value long")
    sums = empty.unionByName(single).unionByName(both).groupBy("a", "b").agg(F.sum("value").alias("value"))
    names = groups.select("gid", "lang", "source")
    named = sums.join(names.withColumnRenamed("gid", "a"), "a").join(names.select(F.col("gid").alias("b"), F.col("source").alias("item")), "b")
    return _ranked(named.select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
