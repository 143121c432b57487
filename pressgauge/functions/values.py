"""Choosing between columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def first_truthy(*values: Column | str) -> Column:
    """First value that is neither NULL nor empty; the last one is taken as it is."""
    *head, last = [col_of(v) for v in values]
    return F.coalesce(*[F.nullif(v, F.lit("")) for v in head], last)


def rounded_avg(value: Column | str) -> Column:
    """Mean rounded half away from zero, as an integer."""
    return F.round(F.avg(col_of(value))).cast("int")


def week_of(ts: Column | str) -> Column:
    """Monday 00:00 of the week holding ``ts``."""
    return F.date_trunc("week", col_of(ts))


def with_computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters and projections may use freely.

    Catalyst copies a column's expression into every filter it pushes down,
    which would run a regular-expression chain once per use. A generator is a
    boundary filters stay above, so the value is computed once per row.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))
