"""Model responses landed as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.tactics import response_field, response_tactics
from pressgauge.functions.values import with_computed


NOT_JSON, IS_NULL, NOT_INTEGER = "response is not JSON", "response is null", "spi_score is not an integer"


def parse_responses(responses: DataFrame) -> DataFrame:
    """Adds the scored fields and the ``tactics`` variants; the body is kept as ``raw_output``.

    A body that is not JSON leaves every field NULL. ``error_message`` says why a
    response gives no scan, NULL if it does: it is not JSON, it is JSON null, or it
    has a score that the integer column of scans cannot hold (a fraction, a number
    out of its range, text, a truth value, a list or an object). A missing or null
    score is none of these. Each body is parsed once.
    """
    given = response_field(F.col("doc"), "spi_score", "variant")
    kind = F.schema_of_variant(given)
    number = F.when(kind != "BOOLEAN", response_field(F.col("doc"), "spi_score", "double"))
    score = F.when(number == F.floor(number), number).try_cast("int")
    unfit = given.isNotNull() & (kind != "VOID") & score.isNull()
    return (
        with_computed(responses, "doc", F.try_parse_json("body"))
        .withColumns(
            {
                "spi_score": score,
                "error_message": F.when(F.col("doc").isNull(), NOT_JSON)
                .when(F.schema_of_variant("doc") == "VOID", IS_NULL)
                .when(unfit, NOT_INTEGER),
                "the_play": response_field(F.col("doc"), "the_play"),
                "emotional_targets": response_field(F.col("doc"), "emotional_targets"),
                "blind_spots": response_field(F.col("doc"), "blind_spots"),
                "the_verdict": response_field(F.col("doc"), "the_verdict"),
                "tactics": response_tactics(F.col("doc")),
            }
        )
        .withColumnRenamed("body", "raw_output")
        .drop("doc")
    )
