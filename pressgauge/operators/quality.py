"""Data-quality checks; none of them moves more than counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.functions.tactics import response_field


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows without a parent."""
    return child.join(parent.select(key), key, "left_anti")


def cascade(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Child rows that survive after parents were deleted."""
    return child.join(parent.select(key), key, "left_semi")


def unknown_codes(tactics: DataFrame, patterns: DataFrame) -> DataFrame:
    """Tactic codes the pattern dimension does not list, with their row counts.

    Codes are counted before the join, so it sees one row per code.
    """
    used = tactics.filter("tactic_code is not null").groupBy("tactic_code").agg(F.count("*").alias("rows"))
    ids = patterns.select(F.col("pattern_id").alias("tactic_code")).distinct()
    return used.join(ids, "tactic_code", "left_anti")


def code_mismatch(responses: DataFrame) -> DataFrame:
    """How often a tactic's vector code differs from its row code (both are kept as they are)."""
    entry = responses.select(F.explode("tactics").alias("t")).select(
        F.coalesce(
            response_field(F.col("t"), "name"), response_field(F.col("t"), "tactic_code"), F.lit("unknown")
        ).alias("vector_code"),
        response_field(F.col("t"), "code").alias("row_code"),
    )
    differs = ~F.col("vector_code").eqNullSafe(F.col("row_code"))
    return entry.agg(F.count("*").alias("tactics"), F.count_if(differs).alias("mismatches"))


def constraint_report(
    df: DataFrame,
    not_null: list[str] = (),
    accepted: dict[str, tuple[str, ...]] | None = None,
    unique: list[str] = (),
) -> DataFrame:
    """Violations per rule: one pass for row rules, one keyed count per unique column."""
    rules: dict[str, Column] = {f"{c} not null": F.col(c).isNull() for c in not_null}
    for column, values in (accepted or {}).items():
        rules[f"{column} accepted"] = F.col(column).isNotNull() & ~F.col(column).isin(*values)
    counted = df.agg(*[F.count_if(bad).alias(name) for name, bad in rules.items()])
    report = counted.select(
        F.inline(
            F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules])
        )
    )
    for column in unique:
        repeated = (
            df.filter(F.col(column).isNotNull())
            .groupBy(column)
            .agg(F.count("*").alias("n"))
            .agg(F.count_if(F.col("n") > 1).alias("violations"))
            .select(F.lit(f"{column} unique").alias("rule"), "violations")
        )
        report = report.unionByName(repeated)
    return report
