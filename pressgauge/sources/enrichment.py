"""Publisher-credibility corpus: JSON arrays of records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge.functions.labels import derive_credibility, normalise_bias, normalise_factuality
from pressgauge.functions.urls import normalise_domain
from pressgauge.functions.values import first_truthy

CORPUS_SCHEMA = (
    "array<struct<source_url_normalized:string,url:string,domain:string,"
    "bias:string,factual_reporting:string,country:string>>"
)


def read_enrichment_files(spark: SparkSession, path: str) -> DataFrame:
    """Corpus files as payload rows ``(payload_no, body)``, numbered by file name order in Spark."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("payload_no"), F.col("value").alias("body")
    )


def parse_enrichment(payloads: DataFrame) -> DataFrame:
    """One row per record with its array position; ``(payload_no, pos)`` is the file order."""
    return payloads.select(
        "payload_no", F.posexplode(F.from_json("body", CORPUS_SCHEMA)).alias("pos", "r")
    ).select("payload_no", "pos", "r.*")


def normalise_enrichment(records: DataFrame) -> DataFrame:
    """Dimension rows from raw records; records without a usable domain are dropped."""
    bias = normalise_bias("bias")
    factuality = normalise_factuality("factual_reporting")
    none = F.lit(None).cast("string")
    return (
        records.withColumns(
            {
                "key_domain": normalise_domain(first_truthy("source_url_normalized", "url", "domain")),
                "mbfc_bias": bias,
                "mbfc_factuality": factuality,
            }
        )
        .filter(F.col("key_domain") != "")
        .select(
            "payload_no",
            "pos",
            F.col("key_domain").alias("domain"),
            "mbfc_bias",
            "mbfc_factuality",
            first_truthy("country", none).alias("mbfc_country"),
            derive_credibility("mbfc_bias", "mbfc_factuality").alias("mbfc_credibility"),
            F.lit("mbfc").alias("source"),
        )
    )
