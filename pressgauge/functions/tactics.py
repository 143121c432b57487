"""Reading detected tactics out of a model response.

A response's ``tactics`` is an ``array<variant>``: elements are objects, and in
older responses also bare strings.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.values import first_truthy


def response_field(body: Column, path: str, sql_type: str = "string") -> Column:
    """One field of a response; NULL when missing or of another type."""
    return F.try_variant_get(body, f"$.{path}", sql_type)


def response_tactics(body: Column) -> Column:
    """The ``tactics`` array; NULL when missing or not an array."""
    return response_field(body, "tactics", "array<variant>")


def vector_entry(tactic: Column) -> Column:
    """Struct ``(code, weight)``: the name comes before the code, severity gives the weight."""
    severity = response_field(tactic, "severity")
    weight = F.lit(C.DEFAULT_WEIGHT)
    for label, value in C.SEVERITY_WEIGHT.items():
        weight = F.when(severity == label, F.lit(value)).otherwise(weight)
    code = F.coalesce(response_field(tactic, "name"), response_field(tactic, "tactic_code"), F.lit("unknown"))
    return F.struct(code.alias("code"), weight.cast("int").alias("weight"))


def tactic_vector(tactics: Column) -> Column:
    """Weighted codes of all tactics; NULL for no, or an empty, array."""
    return F.when(F.size(tactics) > 0, F.transform(tactics, vector_entry))


def tactic_fields(tactic: Column) -> Column:
    """Row form of a tactic: missing fields fall through, empty strings stay."""
    field = lambda name: response_field(tactic, name)
    return F.struct(
        field("code").alias("tactic_code"),
        F.coalesce(field("label"), field("name")).alias("tactic_label"),
        field("severity").alias("severity"),
        F.coalesce(field("evidence"), field("excerpt")).alias("evidence_excerpt"),
    )


def tactic_fields_v1(tactic: Column) -> Column:
    """Older row form: empty strings fall through too, and a bare string is its own label."""
    field = lambda name: response_field(tactic, name)
    itself = F.when(F.schema_of_variant(tactic) == "STRING", F.try_variant_get(tactic, "$", "string")).otherwise(
        F.to_json(tactic)
    )
    none = F.lit(None).cast("string")
    return F.struct(
        first_truthy(field("code"), none).alias("tactic_code"),
        first_truthy(field("label"), field("name"), itself).alias("tactic_label"),
        first_truthy(field("severity"), none).alias("severity"),
        first_truthy(field("evidence"), none).alias("evidence_excerpt"),
    )
