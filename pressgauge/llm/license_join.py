"""License scans: phrase places, and an exact set-similarity join of text blocks with notices.

A block is a line. A notice is found in a block when at least ``threshold`` of
the notice's distinct tokens occur in the block. Tokens are ordered from rare to
frequent over all blocks of the corpus; a notice of t tokens that needs o of them
can only be met through one of its first t - o + 1 tokens (prefix filter), by a
block of at least o tokens (length filter), and where enough tokens remain after
the first common one (positional filter). What is left is verified exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.llm.common import alnum_words, lowered, text_key

# Phrases and their labels.
PHRASES = (
    (("mit", "license"), "mit"),
    (("apache", "license"), "apache"),
    (("general", "public", "license"), "gpl"),
)

# Wording of public license notices, by label.
NOTICES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
)


def notice_tokens(notices=NOTICES) -> list[tuple[int, str, list[str]]]:
    """(number, label, distinct tokens) of each notice."""
    kept = "".join(chr(c) if 48 <= c <= 57 or 97 <= c <= 122 else " " for c in range(128))
    table = {c: kept[c] for c in range(128)}
    lower = lambda text: "".join(c.lower() if c.isascii() else c for c in text)
    return [(i, label, list(dict.fromkeys(lower(text).translate(table).split()))) for i, (label, text) in enumerate(notices)]


def blocks(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per line that has a word: document, its text's key, line number, distinct tokens."""
    lines = docs.select(
        F.col(id_col).alias("doc_id"),
        text_key(F.col(text_col)).alias("key"),
        F.posexplode(F.split(lowered(F.col(text_col)), "\n")).alias("line", "block"),
    )
    return lines.select("doc_id", "key", "line", F.array_distinct(alnum_words(F.col("block"))).alias("tokens")).where(F.size("tokens") > 0)


def global_order(held: DataFrame, vocabulary: list[str]) -> list[str]:
    """The notices' tokens from rare to frequent over all blocks; ties by token."""
    counted = held.select(F.explode(F.array_intersect("tokens", F.array(*map(F.lit, vocabulary)))).alias("token")).groupBy("token").count()
    seen = {r["token"]: r["count"] for r in counted.collect()}  # at most one row per notice token
    return sorted(vocabulary, key=lambda t: (seen.get(t, 0), t))


def notices_in_blocks(
    spark: SparkSession, docs: DataFrame, threshold: float = 0.8, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every (doc_id, key, line, notice, label, containment) that meets the threshold."""
    held = blocks(docs, id_col, text_col)
    parsed = [n for n in notice_tokens(notices) if n[2]]
    order = global_order(held, sorted({t for _, _, tokens in parsed for t in tokens}))
    rank = {t: i for i, t in enumerate(order)}
    index = []
    for number, label, tokens in parsed:
        ranked = sorted(tokens, key=rank.__getitem__)
        need = math.ceil(threshold * len(ranked) - 1e-9)
        index += [(t, place, number, label, ranked, need) for place, t in enumerate(ranked[: len(ranked) - need + 1])]
    prefixes = spark.createDataFrame(index, "token string, place int, notice int, label string, ranked array<string>, need int")
    ordered = F.array(*map(F.lit, order))
    probe = F.array(*map(F.lit, sorted({row[0] for row in index})))
    candidates = (
        held.where(F.arrays_overlap("tokens", probe))
        # a block's tokens that occur in any notice, from rare to frequent: the rest can never match
        .withColumn("tokens", F.array_intersect(ordered, F.col("tokens")))
        .select("*", F.posexplode("tokens").alias("at", "token"))
        .join(prefixes, "token")
    )
    earlier = F.arrays_overlap(F.slice("tokens", 1, F.col("at")), F.slice("ranked", 1, F.col("place")))
    remaining = 1 + F.least(F.size("tokens") - F.col("at") - 1, F.size("ranked") - F.col("place") - 1)
    common = F.size(F.array_intersect("tokens", "ranked"))
    return (
        candidates.where(F.size("tokens") >= F.col("need"))
        .where(~earlier & (remaining >= F.col("need")))
        .withColumn("common", common)
        .where(F.col("common") >= F.col("need"))
        .select("doc_id", "key", "line", "notice", "label", (F.col("common") / F.size("ranked")).alias("containment"))
    )


def _starts(phrase: tuple[str, ...]) -> Column:
    """Positions in ``words`` where the phrase begins, from the positions of its last word in ``spots``."""
    before = [(back, word) for back, word in enumerate(reversed(phrase))]

    def matches(at: Column) -> Column:
        hit = F.lit(True)
        for back, word in before:
            hit = hit & F.coalesce(F.get("words", at - back) == word, F.lit(False))
        return hit

    return F.transform(F.filter("spots", matches), lambda at: (at - len(phrase) + 1).cast("long"))


def phrase_places(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, key, n_words and, per phrase label, the word positions where the phrase begins."""
    words = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("key"), alnum_words(lowered(F.col(text_col))).alias("words"))
    last = sorted({phrase[-1] for phrase, _ in PHRASES})
    spots = F.when(
        F.arrays_overlap("words", F.array(*map(F.lit, last))),
        F.filter(F.transform("words", lambda w, i: F.when(w.isin(last), i)), lambda i: i.isNotNull()),
    ).otherwise(F.array().cast("array<int>"))
    held = words.withColumn("spots", spots)
    columns = [_starts(phrase).alias(label) for phrase, label in PHRASES]
    return held.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), *columns)


def scan_licenses(
    spark: SparkSession, docs: DataFrame, threshold: float = 0.8, notices=NOTICES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Phrase counts and license labels of every document.

    score is the highest containment found, 1 where a phrase stands. A null text
    has no words; a null id is kept; repeated rows each give a row; an empty table
    gives none; further columns are left aside.
    """
    base = phrase_places(docs, id_col, text_col)
    every = [label for _, label in PHRASES]
    places = F.concat(*every)
    labels = F.array_sort(F.array_compact(F.array(*(F.when(F.size(x) > 0, F.lit(x)) for x in every))))
    base = base.select(
        "doc_id", "key", "n_words", F.size(places).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"), labels.alias("phrase_labels"),
    )
    found = (
        notices_in_blocks(spark, docs, threshold, notices, id_col, text_col)
        .groupBy(F.col("doc_id").alias("found_id"), F.col("key").alias("found_key"))
        .agg(F.array_sort(F.collect_set("label")).alias("found"), F.max("containment").alias("best"), F.countDistinct("line").alias("n_blocks"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("found_id")) & (F.col("key") == F.col("found_key"))
    nothing = F.array().cast("array<string>")
    return base.join(found, same, "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("phrase_labels", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("phrase_labels", F.coalesce("found", nothing))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        F.coalesce("n_blocks", F.lit(0)).cast("long").alias("n_notice_blocks"),
    )
