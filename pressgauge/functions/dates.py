"""Publication dates as they appear in feeds and discovery lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressgauge.functions.values import col_of

# Accepted formats. A leading day name is cut first because
# Spark's parser refuses the day-name letter.
DAY_NAME = r"^[A-Za-z]{3,}, *"
RFC822_FORMATS = ("d MMM yyyy HH:mm:ss Z", "d MMM yyyy HH:mm:ss z")
DISCOVERY_FORMAT = "yyyyMMdd'T'HHmmssX"


def parse_published(raw: Column | str) -> Column:
    """Timestamp of an RFC-822, ISO-8601 or compact discovery date; NULL when unreadable."""
    raw = F.trim(col_of(raw))
    undated = F.regexp_replace(raw, DAY_NAME, "")
    return F.coalesce(
        *[F.try_to_timestamp(undated, F.lit(fmt)) for fmt in RFC822_FORMATS],
        F.try_to_timestamp(raw, F.lit(DISCOVERY_FORMAT)),
        raw.try_cast("timestamp"),
    )


def date_is_bad(raw: Column | str) -> Column:
    """True when a date was given but could not be read."""
    return F.nullif(col_of(raw), F.lit("")).isNotNull() & parse_published(raw).isNull()
