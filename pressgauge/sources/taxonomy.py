"""Pattern definitions: a line-oriented document read into dimensions.

A document is one file; ``line_no`` restarts per file, so the windows below
are partitioned by file and stay as small as one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.sources.seeds import values_frame

# Line formats of the document.
PATTERN_LINE = r"^([A-Z]\d{2}) \| (.+)$"
SECTION_LINE = r"^# SECTION [A-Z]: (.+)$"
SUBSECTION_LINE = r"^## ([A-Z]\d+: .+)$"
DISPLAY_LINE = r"^# (\S.*?) +→ +([A-Z]\d{2})( \(enhanced\))? +→ +Layer (\S+)"
DETECTION_CLAUSE = r"Detection: (.+)$"
ENHANCED_CLAUSE = r'Enhanced by Layer (\d): "([^"]+)"'
NAME_LAYER = r"\(Layer ([\d/]+)"


def split_lines(documents: DataFrame) -> DataFrame:
    """``documents(path, body)`` to ``(path, line_no, value)``, lines counted from 1."""
    return documents.select(
        "path", F.posexplode(F.split("body", "\r?\n")).alias("idx", "value")
    ).select("path", (F.col("idx") + 1).alias("line_no"), "value")


def read_taxonomy(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the definition documents below ``path``."""
    return split_lines(
        spark.read.text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))
    )


def _group(pattern: str, index: int = 1):
    return F.nullif(F.regexp_extract("value", pattern, index), F.lit(""))


def parse_patterns(lines: DataFrame) -> DataFrame:
    """One row per pattern: id, prefix, name, description, section and subsection.

    The category key is the id prefix; section letters repeat in the document.
    """
    in_file = Window.partitionBy("path").orderBy("line_no")
    carried = lines.withColumns(
        {
            "section": F.last(_group(SECTION_LINE), ignorenulls=True).over(in_file),
            "subsection": F.last(_group(SUBSECTION_LINE), ignorenulls=True).over(in_file),
            "next_line": F.lead("value").over(in_file),
            "pattern_id": _group(PATTERN_LINE),
        }
    )
    return carried.filter(F.col("pattern_id").isNotNull()).select(
        "path",
        "line_no",
        "pattern_id",
        F.substring("pattern_id", 1, 1).alias("prefix"),
        F.regexp_extract("value", PATTERN_LINE, 2).alias("name"),
        F.col("next_line").alias("description"),
        "section",
        "subsection",
    )


def pattern_attrs(patterns: DataFrame) -> DataFrame:
    """Detection clause, enhancing layer and name, and layer tag of each pattern."""

    def part(column: str, pattern: str, index: int = 1):
        return F.nullif(F.regexp_extract(column, pattern, index), F.lit(""))

    return patterns.select(
        "path",
        "pattern_id",
        part("description", DETECTION_CLAUSE).alias("detection"),
        part("description", ENHANCED_CLAUSE).try_cast("int").alias("enhanced_layer"),
        part("description", ENHANCED_CLAUSE, 2).alias("enhanced_name"),
        part("name", NAME_LAYER).alias("name_layer"),
    )


def display_names(lines: DataFrame) -> DataFrame:
    """Map from pattern id to the name users see."""
    return lines.select(
        "path",
        _group(DISPLAY_LINE, 2).alias("pattern_id"),
        F.regexp_extract("value", DISPLAY_LINE, 1).alias("display_name"),
        (F.regexp_extract("value", DISPLAY_LINE, 3) != "").alias("enhanced"),
        F.regexp_extract("value", DISPLAY_LINE, 4).alias("source_layer"),
    ).filter(F.col("pattern_id").isNotNull())


def audience_routing(spark: SparkSession) -> DataFrame:
    """One row per (pattern id, audience) from the fixed ranges."""
    rows = [(prefix, low, high, name) for prefix, low, high, names in C.AUDIENCE_RANGES for name in names]
    return (
        values_frame(spark, rows, "prefix, low, high, audience")
        .select("prefix", "audience", F.explode(F.sequence("low", "high")).alias("number"))
        .select(
            F.concat("prefix", F.lpad(F.col("number").cast("string"), 2, "0")).alias("pattern_id"),
            "audience",
        )
    )
