"""Bias, factuality and credibility labels."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.text import trim_space
from pressgauge.functions.values import col_of


def _canonical(raw: Column | str, vocabulary: tuple[str, ...]) -> Column:
    """Vocabulary spelling of ``raw``; unknown labels stay raw, empty ones become NULL."""
    raw = F.nullif(col_of(raw), F.lit(""))
    spelling = F.create_map(*[F.lit(x) for x in chain.from_iterable((v.lower(), v) for v in vocabulary)])
    return F.coalesce(F.try_element_at(spelling, trim_space(F.lower(raw))), raw)


def normalise_bias(raw: Column | str) -> Column:
    return _canonical(raw, C.BIAS_LABELS)


def normalise_factuality(raw: Column | str) -> Column:
    return _canonical(raw, C.FACTUALITY_LABELS)


def derive_credibility(bias: Column | str, factuality: Column | str) -> Column:
    """DISPUTED by bias first, then LOW or HIGH by factuality, else MIXED."""
    return (
        F.when(col_of(bias).isin(*C.DISPUTED_BIAS), "DISPUTED")
        .when(col_of(factuality).isin(*C.LOW_FACTUALITY), "LOW")
        .when(col_of(factuality).isin(*C.HIGH_FACTUALITY), "HIGH")
        .otherwise("MIXED")
    )
