"""Counters of a run, gathered while its data is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pressgauge.sources.discovery import parse_discovery
from pressgauge.sources.feeds import FEED_SCHEMA, parse_feeds


def observed(rows: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, Observation]:
    """``rows`` that count themselves when they are next written: no pass of their own.

    A map task that runs again after an executor was lost may be counted again, so
    counters are for watching runs; tables that must agree are counted from the data.
    """
    watch = Observation(name)
    return rows.observe(watch, *(c.alias(n) for n, c in counters.items())), watch


def malformed_feed(body: Column) -> Column:
    """The payload is no XML; XML without items is an empty feed and no error."""
    read = F.from_xml(body, f"{FEED_SCHEMA}, broken string", {"columnNameOfCorruptRecord": "broken"})
    return read.isNull() | read["broken"].isNotNull()


def malformed_list(body: Column) -> Column:
    return F.try_parse_json(body).isNull()


def counted_feeds(payloads: DataFrame) -> tuple[DataFrame, Observation]:
    """Items of well-formed feeds; counts ``payloads`` and ``errors``, which the items alone cannot tell."""
    body = F.col("body")
    judged = payloads.withColumn("malformed", malformed_feed(body))
    seen, watch = observed(judged, "feeds", payloads=F.count("*"), errors=F.count_if("malformed"))
    return parse_feeds(seen.where("not malformed")), watch


def counted_lists(payloads: DataFrame) -> tuple[DataFrame, Observation]:
    """Articles of well-formed discovery lists; counts ``payloads`` and ``errors``."""
    judged = payloads.withColumn("malformed", malformed_list(F.col("body")))
    seen, watch = observed(judged, "lists", payloads=F.count("*"), errors=F.count_if("malformed"))
    return parse_discovery(seen.where("not malformed")), watch


def write_counted(parts: dict[str, tuple[DataFrame, Observation]], path: str, run: str) -> None:
    """Write each part of a run, counting its rows as ``found``, then one row per part and counter.

    A run owns its directories; repeating it replaces its rows and counters.
    """
    spark: SparkSession | None = None
    rows = []
    for name, (df, watch) in parts.items():
        spark = df.sparkSession
        counted, found = observed(df, f"{name}-found", found=F.count("*"))
        counted.write.mode("overwrite").parquet(f"{path}/{name}/run={run}")
        rows += [(name, counter, value) for counter, value in {**(watch.get if watch else {}), **found.get}.items()]
    if spark is not None:
        spark.createDataFrame(rows, "part string, counter string, value long").coalesce(1).write.mode("overwrite").parquet(f"{path}/counters/run={run}")
