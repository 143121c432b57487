"""Target-distribution importance resampling, with an exact cut found by weighted medians of medians.

Word runs of a text fall into hashed buckets; a bucket's gain is the logarithm of
how much commoner it is in the target than in the corpus. A document's weight is
the sum of the gains of its features, read from one array, and Gumbel noise drawn
from its id turns the weight into a score, so the highest scores are a weighted
sample without replacement.

The cut is found without a sort of all keys. Each round splits the keys that are
left at a pivot; every task sends the median of its keys on either side and their
number. The median of those medians, weighted by the numbers, is the pivot of the
next round on the side that holds the cut: at least a quarter of that side's keys
lie above it and a quarter below, so every round discards a guaranteed share. Once
no more keys are left than one task's group holds, they are sorted and the cut is
read off. Only the keys above the cut are sorted for their ranks.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.llm.common import map_batches, stored

BUCKETS, RUN, LEAST_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: The most keys that a task takes one median of, and that are sorted for the last step.
GROUP = 1 << 16
_NO_ID = 2**63 - 1

_ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def features(text: bytes, run: int = RUN, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """(words, bucket of every run of 1 to ``run`` consecutive words) of a UTF-8 text; A-Z are lower-cased."""
    words = text.translate(_ALNUM).split()
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1 if words else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1]).tolist() if words else []
    ends = ends.tolist()
    found: list[int] = []
    for size in range(run):
        found += [zlib.crc32(joined[a:b]) for a, b in zip(starts, ends[size:], strict=False)]
    return len(words), np.array(found, np.int64) % buckets


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            yield batch.slice(at, 500)


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, run: int = RUN) -> list[int]:
    """Features per bucket over all rows of a table with a column ``text``; one number a bucket reaches the driver."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in _parts(batches):
            for text in part.column(0):
                total += np.bincount(features(text.as_py(), run, buckets)[1], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int64()), pa.array(total[hit], pa.int64())], names=["bucket", "n"])

    rows = map_batches(texts.select(_raw("text")), counted, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = [0] * buckets
    for row in rows:
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln((t + 1)(S + B) / ((s + 1)(T + B)))) for each of the B buckets."""
    s_all, t_all, b = float(sum(corpus)), float(sum(target)), len(corpus)
    ratios = ((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)) for s, t in zip(corpus, target, strict=True))
    return np.array([math.floor(1000.0 * math.log(r)) for r in ratios], np.int64)


def _raw(text_col: str) -> Column:
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")


def weights(docs: DataFrame, gain: np.ndarray, run: int = RUN) -> DataFrame:
    """doc_id, n_words, n_features and weight of a table of doc_id and text (binary)."""
    names = ["doc_id", "n_words", "n_features", "weight"]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            rows = []
            for text in part.column(1):
                n, found = features(text.as_py(), run, len(gain))
                rows.append((n, len(found), int(gain[found].sum())))
            columns = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, pa.int64()) for c in columns)], names=names)

    return map_batches(docs, scored, ", ".join(f"{n} long" for n in names))


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(-1000 ln(-ln u)) for the u in (0, 1) that a hash of the id gives; a null id hashes like an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(u))).cast("long")


# Keys rank by score, highest first, then by id, lowest first; a null id comes last.
def _ident() -> Column:
    return F.coalesce(F.col("doc_id"), F.lit(_NO_ID)).alias("id")


def _before(score: Column, ident: Column, cut: tuple[int, int]) -> Column:
    """The key ranks before ``cut``."""
    return (score > cut[0]) | ((score == cut[0]) & (ident < cut[1]))


def _groups(keys: DataFrame, pivot: tuple[int, int] | None, group: int) -> DataFrame:
    """side (-1 before the pivot, 0 at it, 1 after it), the median key of at most ``group`` keys, their number."""
    names = ["side", "score", "id", "n"]

    def halves(score: np.ndarray, ident: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        if pivot is None:
            side = np.full(len(score), 1)
        else:
            first = (score > pivot[0]) | ((score == pivot[0]) & (ident < pivot[1]))
            side = np.where(first, -1, np.where((score == pivot[0]) & (ident == pivot[1]), 0, 1))
        for s in (-1, 0, 1):
            at = np.flatnonzero(side == s)
            if len(at):
                order = np.lexsort((ident[at], -score[at]))
                middle = at[order[(len(at) - 1) // 2]]
                yield s, int(score[middle]), int(ident[middle]), len(at)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows: list[tuple[int, int, int, int]] = []
        for batch in batches:
            both = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)])
            for at in range(0, both.shape[1], group):
                held.append(both[:, at : at + group])
                if sum(h.shape[1] for h in held) >= group:
                    rows += halves(*np.concatenate(held, axis=1))
                    held = []
        if held:
            rows += halves(*np.concatenate(held, axis=1))
        columns = zip(*rows, strict=True) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return map_batches(keys, run, ", ".join(f"{n} long" for n in names))


def _middles(groups: DataFrame) -> dict[int, tuple[int, tuple[int, int]]]:
    """Per side the number of keys and the weighted median of the groups' medians; three rows at most."""
    order = Window.partitionBy("side").orderBy(F.col("score").desc(), "id")
    sums = groups.withColumns({"upto": F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0)), "all": F.sum("n").over(Window.partitionBy("side"))})
    crossing = sums.where((2 * F.col("upto") >= F.col("all")) & (2 * (F.col("upto") - F.col("n")) < F.col("all")))
    return {r["side"]: (r["all"], (r["score"], r["id"])) for r in crossing.collect()}


def _between(keys: DataFrame, high: tuple[int, int] | None, low: tuple[int, int] | None) -> DataFrame:
    """Keys that rank after ``high`` and before ``low``; the bare bounds on the score reach the scan."""
    score, ident = F.col("score"), F.col("id")
    if high is not None:
        keys = keys.where((score <= high[0]) & ((score < high[0]) | (ident > high[1])))
    if low is not None:
        keys = keys.where((score >= low[0]) & _before(score, ident, low))
    return keys


def cutoff(keys: DataFrame, k: int, group: int = GROUP) -> tuple[int, int] | None:
    """The k-th key of a written table of score and id, by rounds of weighted medians; None for k below 1."""
    if k < 1:
        return None
    low: tuple[int, int] | None = None  # keys left rank after ``high`` and before ``low``
    high: tuple[int, int] | None = None
    pivot = None
    while True:
        sides = _middles(_groups(_between(keys, high, low), pivot, group))
        before, at = sides.get(-1, (0, None)), sides.get(0, (0, None))
        if pivot is not None:
            if before[0] < k <= before[0] + at[0]:
                return pivot
            if k <= before[0]:
                low, remaining = pivot, before
            else:
                high, remaining, k = pivot, sides[1], k - before[0] - at[0]
        elif 1 in sides:
            remaining = sides[1]
        else:
            return None
        if remaining[0] <= group:  # few enough for one sort
            row = _between(keys, high, low).orderBy(F.col("score").desc(), "id").offset(k - 1).limit(1).first()
            return (row["score"], row["id"])
        pivot = remaining[1]


def ranks(winners: DataFrame, order: list[Column]) -> DataFrame:
    """``winners`` with ``rank``, from 1 in the given order: a range-partitioned sort, then each range's offset."""
    place = F.monotonically_increasing_id()
    dealt = winners.repartitionByRange(*order).sortWithinPartitions(*order)
    sorted_rows = stored(dealt.withColumn("place", place), "sorted-winners")
    sorted_rows = sorted_rows.withColumns({"range": F.shiftright("place", 33), "nth": F.col("place").bitwiseAND(2**33 - 1)})
    sizes = sorted_rows.groupBy("range").agg(F.count("*").alias("n"))
    offsets = sizes.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("before"))
    return sorted_rows.join(offsets, "range").withColumn("rank", F.col("before") + F.col("nth") + 1).drop("range", "nth", "before", "place")


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    group: int = GROUP,
) -> DataFrame:
    """Weigh every document by how much it reads like ``target`` and draw ``percent`` of those with enough words.

    Returns doc_id, n_features, weight, score, rank (null where not drawn) and
    n_words. Null texts have no words and weight 0; a null id hashes like an empty
    one and ranks after others of its score; rows that repeat id and text tie, and
    which of them is drawn at the cut cannot be told apart; an empty corpus gives
    no rows, an empty target gains that only speak of the corpus; further columns
    are left aside.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), _raw(text_col))
    gain = gains(bucket_counts(docs.select(F.col(text_col).alias("text"))), bucket_counts(target.select("text")))
    score = (F.col("weight") + gumbel(F.col("doc_id"), seed)).alias("score")
    scored = stored(weights(narrow, gain).select("*", score), "scored-documents")
    fit = F.col("n_words") >= least_words
    k = scored.where(fit).count() * percent // 100
    keys = scored.where(fit).select("score", _ident())
    cut = cutoff(keys, k, group)
    if cut is None:
        return _shaped(scored.withColumn("rank", F.lit(None).cast("long")))
    score, ident = F.col("score"), _ident()
    wins = fit & (_before(score, ident, cut) | ((score == cut[0]) & (ident == cut[1])))
    drawn = ranks(scored.where(wins), [score.desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("weight")])
    drawn = drawn.withColumn("rank", F.when(F.col("rank") <= k, F.col("rank")))
    return _shaped(scored.where(~wins).withColumn("rank", F.lit(None).cast("long")).unionByName(drawn))


def _shaped(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
