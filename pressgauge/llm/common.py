"""Helpers the operators share: tokens, row keys, stored intermediates and given tables."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.session import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same separators in text whose letters A-Z have not been lower-cased yet.
NOT_ALNUM_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    The files outlive a lost executor, and every later use sees the same rows.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lowered(text: Column) -> Column:
    """``text`` with A-Z in lower case and all else as it is; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def alnum_words(lowered_text: Column) -> Column:
    """Runs of a-z, 0-9 and non-ASCII characters of a lower-cased text."""
    return F.array_remove(F.split(lowered_text, NOT_ALNUM), "")


def text_key(text: Column) -> Column:
    """Two independent 64-bit hashes of a text; null and empty count as different texts."""
    present = text.isNotNull()
    return F.struct(
        F.xxhash64(text, present).alias("a"), F.xxhash64(F.lit(1), text, present).alias("b")
    )


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the session's Python workers import this package, wherever they run; once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"  # handed out by the driver, as with --py-files
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def map_batches(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)
