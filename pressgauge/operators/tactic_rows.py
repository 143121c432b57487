"""Flattening detected tactics to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.tactics import tactic_fields, tactic_fields_v1


def flatten_tactics(responses: DataFrame, dialect: str = "v2") -> DataFrame:
    """One row per detected tactic; content without tactics gives no rows."""
    fields = tactic_fields_v1 if dialect == "v1" else tactic_fields
    version = F.lit(C.LEGACY_VERSION) if dialect == "v1" else F.col("taxonomy_version")
    return responses.select(
        F.col("content_hash").alias("scan_id"),
        version.alias("taxonomy_version"),
        F.posexplode("tactics").alias("tactic_pos", "t"),
    ).select("scan_id", "tactic_pos", fields(F.col("t")).alias("row"), "taxonomy_version").select(
        "scan_id", "tactic_pos", "row.*", "taxonomy_version"
    )


def with_display_name(tactics: DataFrame, names: DataFrame) -> DataFrame:
    """What users see: the display name where one exists, else the label, and never the layer."""
    shown = names.select(F.col("pattern_id").alias("tactic_code"), "display_name")
    return (
        tactics.join(shown, "tactic_code", "left")
        .withColumn("shown_name", F.coalesce("display_name", "tactic_label"))
        .drop("display_name", "tactic_label")
    )
