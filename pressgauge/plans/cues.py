"""Cue phrases of pattern definitions, found in texts through an index of their first words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.operators.graph import written

#: A phrase is entered under its first words, this many or all it has.
FIRST = 3


def cue_words(text: Column) -> Column:
    """Runs of letters, digits and apostrophes of the lower-cased text."""
    return F.array_remove(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[’]", "'"), r"[^\p{L}\p{N}']+"), "")


def cue_lexicon(patterns: DataFrame, pattern_id: str = "pattern_id", text: str = "description") -> DataFrame:
    """Distinct pattern_id, cue: the phrases that a pattern's text quotes, as words joined by one space."""
    quoted = F.regexp_extract_all(F.regexp_replace(F.col(text), "[“”]", '"'), F.lit('"([^"]+)"'), F.lit(1))
    phrases = patterns.select(F.col(pattern_id).alias("pattern_id"), F.explode(quoted).alias("phrase"))
    return phrases.select("pattern_id", F.array_join(cue_words(F.col("phrase")), " ").alias("cue")).where("cue <> ''").distinct()


def cue_rates(docs: DataFrame, lexicon: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Occurrences of a pattern's cues per document, and per 1,000 of its words; overlapping ones all count.

    Runs of one to ``FIRST`` words are looked up by hash; a run that opens a longer
    cue is checked word by word against the text. Texts are cut into words once, and
    only those that hold such a run are fetched for the check. The number of cues is
    in no expression: a lexicon of any size is a table in a join.
    """
    words = F.split("cue", " ")
    index = lexicon.select("pattern_id", words.alias("cue_words")).withColumn("n", F.least(F.size("cue_words"), F.lit(FIRST)))
    # a hash passes over the nulls behind the last word
    index = index.withColumn("opening", F.xxhash64("n", *(F.get("cue_words", F.lit(k)) for k in range(FIRST))))
    held = docs.select(F.col(key).alias("doc_id"), cue_words(F.col(text)).alias("w"))
    held = written(held.select("doc_id", "w", F.size("w").alias("words")), "words")

    def openings(w: Column) -> Column:
        at = lambda n: F.transform(
            F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.struct(i.alias("pos"), F.xxhash64(F.lit(n), *(F.get(w, i + (k - 1)) for k in range(n))).alias("opening"))
        )
        none = F.array().cast("array<struct<pos:int,opening:bigint>>")
        return F.concat(*(F.when(F.size(w) >= n, at(n)).otherwise(none) for n in range(1, FIRST + 1)))

    places = held.select("doc_id", F.inline(openings(F.col("w"))))
    rest = F.when(F.size("cue_words") > FIRST, F.col("cue_words")).alias("cue_words")
    by_doc = written(places.join(index, "opening").select("doc_id", "pos", "pattern_id", rest), "openings")
    short = by_doc.where("cue_words is null").select("doc_id", "pattern_id")
    long = written(by_doc.where("cue_words is not null"), "long-openings")
    asked = written(long.select("doc_id").distinct(), "asked")
    long = long.join(held.join(asked, "doc_id", "left_semi"), "doc_id")
    long = long.where(F.slice("w", F.col("pos"), F.size("cue_words")) == F.col("cue_words")).select("doc_id", "pattern_id")
    hits = short.unionByName(long).groupBy("doc_id", "pattern_id").agg(F.count("*").alias("hits"))
    rate = F.round(F.col("hits") * 1000 / F.col("words"), 6)
    return hits.join(held.select("doc_id", "words"), "doc_id").select("doc_id", "pattern_id", "hits", rate.alias("per_1000"))
