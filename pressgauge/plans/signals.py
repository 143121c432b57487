"""Corpus signals. Their definitions and thresholds are this package's own: they are described elsewhere, never computed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pressgauge.functions.urls import extract_domain

WORDS = r"[^a-z0-9]+"


def _words(text: str) -> Column:
    """Distinct runs of a-z and 0-9 of the lower-cased text."""
    return F.array_distinct(F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), WORDS), ""))


def volume_bursts(events: DataFrame, ts: str = "ts", group: str = "event_type", hours: int = 24, z: float = 2.0) -> DataFrame:
    """Hours whose count stands ``z`` deviations above the mean of the ``hours`` hours before, silent hours counting zero.

    The first hours of a group look back to its first event, and need three hours
    of history. Events are counted per group and hour first, and silent hours enter
    as numbers and not as rows, so the window holds one row an hour with events.
    """
    counts = events.groupBy(F.col(group).alias("grp"), F.date_trunc("hour", ts).alias("hour")).agg(F.count("*").alias("n"))
    counts = counts.withColumn("hour_no", F.floor(F.unix_timestamp("hour") / 3600))
    in_order = Window.partitionBy("grp").orderBy("hour_no")
    before = in_order.rangeBetween(-hours, -1)
    none = F.lit(0).cast("long")
    scored = counts.withColumns(
        {
            "span": F.least(F.lit(hours).cast("long"), F.col("hour_no") - F.min("hour_no").over(in_order)),
            "s1": F.coalesce(F.sum("n").over(before), none),
            "s2": F.coalesce(F.sum(F.col("n") * F.col("n")).over(before), none),
        }
    ).filter((F.col("span") >= 3) & (F.col("span") * F.col("s2") > F.col("s1") * F.col("s1")))
    mean = F.col("s1") / F.col("span")
    score = F.round((F.col("n") - mean) / F.sqrt(F.col("s2") / F.col("span") - mean * mean), 6)
    return scored.withColumn("z", score).filter(F.col("z") >= z).select("grp", "hour", "n", "z")


def link_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct (source, target) domains of absolute links; links within a domain are left out."""
    links = F.regexp_extract_all(F.col(html), F.lit(r"""href=["'](https?://[^"'\s>]+)"""), F.lit(1))
    found = pages.select(extract_domain(url).alias("source"), F.explode(links).alias("link"))
    return found.select("source", extract_domain("link").alias("target")).filter("source <> target").distinct()


def citation_cycles(edges: DataFrame) -> DataFrame:
    """Pairs of domains that link to each other, by one grouping of the edges and no self-join."""
    low, high = F.least("source", "target"), F.greatest("source", "target")
    return (
        edges.groupBy(low.alias("first"), high.alias("second"))
        .agg(F.count_distinct(F.col("source") < F.col("target")).alias("ways"))
        .filter("ways = 2")
        .select("first", "second")
    )


def provenance_void(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Which marks of origin a page lacks: author, date, canonical address."""
    low = F.lower(F.coalesce(F.col(html), F.lit("")))
    author = low.rlike(r"""(name|property|itemprop|rel)=["'](article:)?author["']""")
    date = low.rlike(r"""<time[\s>]|(property|itemprop)=["'](article:published_time|datepublished)["']""")
    canonical = low.rlike(r"""rel=["']canonical["']""")
    marks = pages.select(key, author.alias("has_author"), date.alias("has_date"), canonical.alias("has_canonical"))
    return marks.withColumn("void", ~(F.col("has_author") | F.col("has_date") | F.col("has_canonical")))


def template_share(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 3) -> DataFrame:
    """Share of a document's distinct non-empty lines that stand in ``least`` documents or more.

    Copies count as documents. A line is counted per hash, map-side first, and
    the counts are joined back to the lines, a one-sided skew for a hot line.
    """
    lines = F.array_distinct(F.array_remove(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), F.trim), ""))
    each = docs.select(key, F.explode(F.transform(lines, lambda x: F.sha2(x, 256))).alias("line"))
    common = each.groupBy("line").agg(F.count("*").alias("n")).filter(F.col("n") >= least)
    return (
        each.join(common, "line", "left")
        .groupBy(key)
        .agg(F.count("*").alias("lines"), F.count("n").alias("templated"))
        .withColumn("share", F.round(F.col("templated") / F.col("lines"), 6))
    )


def cue_hits(docs: DataFrame, cues: Sequence[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Occurrences of each cue, ignoring case, per document and 1,000 words; only cues that occur."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    words = F.greatest(F.size(F.array_remove(F.split(low, r"\s+"), "")), F.lit(1))

    def occurrences(cue: str) -> Column:
        return ((F.length("low") - F.length(F.replace(F.col("low"), F.lit(cue.lower()), F.lit("")))) / len(cue)).cast("int")

    hits = F.array(*[F.struct(F.lit(c).alias("cue"), occurrences(c).alias("hits")) for c in cues])
    return (
        docs.select(key, low.alias("low"), words.alias("words"))
        .select(key, "words", F.explode(F.filter(hits, lambda h: h["hits"] > 0)).alias("h"))
        .select(key, "h.cue", "h.hits", F.round(F.col("h.hits") * 1000 / F.col("words"), 6).alias("per_1000"))
    )


def repetition_ratio(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """Share of a document's word n-grams that repeat an earlier one."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"\s+"), "")
    held = docs.select(key, words.alias("w"))
    grams = F.transform(
        F.slice("w", 1, F.greatest(F.size("w") - (size - 1), F.lit(0))),
        lambda x, i: F.concat_ws(" ", x, *(F.get("w", i + k) for k in range(1, size))),
    )
    counted = held.select(key, grams.alias("g")).select(key, F.size("g").alias("grams"), F.size(F.array_distinct("g")).alias("kept"))
    share = F.when(F.col("grams") > 0, 1 - F.col("kept") / F.col("grams")).otherwise(0.0)
    return counted.select(key, "grams", F.round(share, 6).alias("ratio"))


def headline_overlap(docs: DataFrame, headline: str, body: str, key: str = "doc_id") -> DataFrame:
    """Share of the headline's distinct words that occur in the body; NULL for a headline without words."""
    held = docs.select(key, _words(headline).alias("h"), _words(body).alias("b"))
    return held.select(
        key,
        F.size("h").alias("headline_words"),
        F.when(F.size("h") > 0, F.round(F.size(F.array_intersect("h", "b")) / F.size("h"), 6)).alias("overlap"),
    )


def migration_trail(scans: DataFrame, key: str = "content_hash", ts: str = "scanned_at") -> DataFrame:
    """For each text seen in several media classes, when each class had it first, and in which order."""
    first = scans.filter("media_class is not null").groupBy(key, "media_class").agg(F.min(ts).alias("first_seen"))
    by_text = Window.partitionBy(key)
    step = F.row_number().over(by_text.orderBy("first_seen", "media_class"))
    return first.withColumns({"classes": F.count("*").over(by_text), "step": step}).filter("classes > 1").drop("classes")
