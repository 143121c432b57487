"""Benchmark decontamination by winnowing.

Both sides keep, of every run of ``WINDOW`` consecutive k-grams, the one with the
smallest hash. A span of K + WINDOW - 1 words or more that a document shares with
an item holds a whole run of k-grams, so both keep the same one in it: joining the
kept fingerprints finds every such span. Each hit names a diagonal (document
position minus item position), along which it is extended and checked word by word;
the diagonals of a document and an item are one row, so its words are read once.
Items shorter than a span are matched whole, by the hash of all their words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.llm.common import NOT_ALNUM_ANY_CASE, alnum_words, lowered, text_key

SPAN = 10
K = 6
WINDOW = SPAN - K + 1


def _gram(hashes: Column, i: Column, k: int) -> Column:
    return F.xxhash64(*(F.get(hashes, i + j) for j in range(k)))


def fingerprints(words: Column, k: int = K, window: int = WINDOW) -> Column:
    """Array of (size k, hash, position) kept by winnowing; ties keep every minimum."""

    def kept(grams: Column) -> Column:
        lows = F.transform(grams, lambda _, i: F.least(*(F.get(grams, i + j) for j in range(window))))
        return F.transform(F.array(F.struct(grams.alias("g"), lows.alias("m"))), lambda s: F.filter(
            F.transform(s["g"], lambda g, i: F.struct(
                F.lit(k).alias("size"), g.alias("hash"), i.alias("pos"),
                (g == F.greatest(*(F.get(s["m"], i - j) for j in range(window)))).alias("low"))),
            lambda f: f["low"]))[0]

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    grams = F.transform(F.array(hashes), lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (k - 1), F.lit(0))), lambda _, i: _gram(h, i, k)))[0]
    # one-element arrays bind the inner arrays once instead of computing them for every position
    return F.transform(F.array(grams), kept)[0]


def whole_grams(words: Column, size: int) -> Column:
    """Every run of ``size`` words as (size, hash, position)."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.transform(F.array(hashes), lambda h: F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (size - 1), F.lit(0))),
        lambda _, i: F.struct(F.lit(size).alias("size"), _gram(h, i, size).alias("hash"), i.alias("pos"), F.lit(True).alias("low"))))[0]


def hit_windows(docs: DataFrame, items: DataFrame, span: int = SPAN) -> DataFrame:
    """Distinct (doc_id, key, item_id, size, start): a window of ``size`` words of the item stands at word ``start``.

    ``docs`` has doc_id, key and text; ``items`` has item_id, item_key and words.
    """
    k = min(K, span)
    window = span - k + 1
    lengths = items.where(F.size("words") < span).select(F.size("words").alias("n")).distinct().collect()
    short = sorted(r["n"] for r in lengths)  # fewer than ``span`` numbers
    of_item = F.when(F.size("words") >= span, fingerprints(F.col("words"), k, window))
    for size in short:
        of_item = of_item.when(F.size("words") == size, whole_grams(F.col("words"), size))
    of_doc = F.concat(fingerprints(F.col("words"), k, window), *(whole_grams(F.col("words"), size) for size in short))
    item_prints = items.select("item_id", "item_key", F.explode(of_item).alias("f")).select(
        "item_id", "item_key", "f.size", "f.hash", F.col("f.pos").alias("item_pos")
    )
    doc_prints = (
        docs.select("doc_id", "key", alnum_words(lowered(F.col("text"))).alias("words"))
        .select("doc_id", "key", F.explode(of_doc).alias("f"))
        .select("doc_id", "key", "f.size", "f.hash", "f.pos")
    )
    diagonals = (
        doc_prints.join(item_prints, ["size", "hash"])
        .groupBy("doc_id", "key", "item_id", "item_key")
        .agg(F.collect_set(F.col("pos") - F.col("item_pos")).alias("shifts"))
    )
    same_doc = F.col("d.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("d.key") == F.col("g.key"))
    same_item = F.col("i.item_id").eqNullSafe(F.col("g.item_id")) & (F.col("i.item_key") == F.col("g.item_key"))
    lined = (
        diagonals.alias("g")
        .join(docs.alias("d"), same_doc)
        .join(items.alias("i"), same_item)
        .select("g.doc_id", "g.key", "g.item_id", "g.shifts", F.col("i.words").alias("item"), alnum_words(lowered(F.col("d.text"))).alias("words"))
    )
    size = F.least(F.lit(span), F.size("item"))

    def along(shift: Column) -> Column:
        first = F.greatest(shift, F.lit(0))
        last = F.least(F.size("words"), F.size("item") + shift) - size
        equal = lambda at: F.slice("words", at + 1, size) == F.slice("item", at - shift + 1, size)
        return F.when(last >= first, F.filter(F.sequence(first, last), equal)).otherwise(F.array().cast("array<int>"))

    starts = F.array_distinct(F.flatten(F.transform("shifts", along)))
    return lined.select("doc_id", "key", "item_id", size.alias("size"), F.explode(starts).alias("start")).distinct()


def _items(benchmark: DataFrame) -> DataFrame:
    words = alnum_words(lowered(F.col("text")))
    return benchmark.select("item_id", words.alias("words")).where(F.size("words") > 0).withColumn("item_key", F.xxhash64("words")).distinct()


def clean(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, in which no window of a benchmark item stands."""
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("key"))
    found = hit_windows(narrow, _items(benchmark), span).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct()
    same = F.col(id_col).eqNullSafe(F.col("__id")) & (text_key(F.col(text_col)) == F.col("__key"))
    return docs.join(found, same, "left_anti")


def decontaminate(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Which words of every document stand in a window of a benchmark item.

    Returns doc_id, n_words, n_hit, n_items, items_sha256 and contaminated. A null
    or empty text has no words and hits nothing; items without words are left out;
    an item without an id counts under the empty name; documents that repeat give
    one row each; an empty table gives none; further columns are left aside.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("key"))
    hits = hit_windows(docs, _items(benchmark), span)
    by_start = Window.partitionBy("doc_id", "key").orderBy("start")
    reach = F.coalesce(F.max(F.col("start") + F.col("size")).over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("start") + F.col("size") - F.greatest(F.col("start"), reach))
    words_hit = (
        hits.groupBy("doc_id", "key", "start").agg(F.max("size").alias("size"))
        .withColumn("fresh", fresh).groupBy("doc_id", "key").agg(F.sum("fresh").alias("n_hit"))
    )
    names = F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit(""))))
    items_hit = hits.groupBy("doc_id", "key").agg(names.alias("names"))
    found = (
        words_hit.alias("w")
        .join(items_hit.alias("n"), F.col("w.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("w.key") == F.col("n.key")))
        .select(F.col("w.doc_id").alias("hit_id"), F.col("w.key").alias("hit_key"), "n_hit", "names")
    )
    n_words = F.size(F.array_remove(F.split(F.coalesce("text", F.lit("")), NOT_ALNUM_ANY_CASE), ""))
    every = docs.select("doc_id", "key", n_words.cast("long").alias("n_words"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("key") == F.col("hit_key"))
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    names = F.coalesce("names", F.array().cast("array<string>"))
    return every.join(found, same, "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(names).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
