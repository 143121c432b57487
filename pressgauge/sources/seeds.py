"""Seed dimensions built from the fixed lists.

They are local relations whose size the planner knows, so joins with them are
broadcast by the session's threshold and need no hint.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge import constants as C


def literal(value: object) -> str:
    """SQL literal of a string, number or None."""
    if value is None:
        return "null"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_frame(spark: SparkSession, rows: Sequence[Sequence[object]], columns: str) -> DataFrame:
    """Local relation of literal rows."""
    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"select * from values {body} as t({columns})")


def feeds(spark: SparkSession, legacy: bool = False) -> DataFrame:
    """Feeds with their ordinal, which is the ingest order; ``legacy`` gives the older list."""
    return values_frame(
        spark,
        [(i, *row) for i, row in enumerate(C.LEGACY_FEEDS if legacy else C.FEEDS)],
        "ordinal, feed_url, name, domain, country, media_class, topic_class",
    )


def feed_slice(feed_rows: DataFrame, start: int = 0, end: int | None = None) -> DataFrame:
    """Feeds of one batch: ordinals ``start`` to ``end``, both included; without ``end`` all that follow."""
    wanted = F.col("ordinal") >= start
    return feed_rows.filter(wanted if end is None else wanted & (F.col("ordinal") <= end))


def themes(spark: SparkSession) -> DataFrame:
    return values_frame(spark, [(i, t[0]) for i, t in enumerate(C.THEMES)], "theme_ordinal, theme")


def search_terms(spark: SparkSession) -> DataFrame:
    """Every search term in every country, in the order they are searched."""
    terms = values_frame(
        spark, [(i, *row) for i, row in enumerate(C.AD_TERMS)], "term_ordinal, term, category"
    )
    countries = F.array(*[F.lit(c) for c in C.AD_COUNTRIES])
    return terms.select(
        "term_ordinal", "term", "category", F.posexplode(countries).alias("country_ordinal", "country")
    )
