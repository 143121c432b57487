"""Host names and domain keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressgauge.functions.text import trim_space
from pressgauge.functions.values import col_of, first_truthy

# Fixed value: fallback host pattern for hosts the URL parser rejects
# (underscores, non-ASCII letters).
HOST_RE = r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^\s/:?#<>^|%@]+)(?:[/:?#]|$)"
WWW = r"(?i)^www\."


def extract_domain(url: Column | str) -> Column:
    """Lower-case host without one leading ``www.``; NULL when there is none."""
    url = col_of(url)
    host = F.coalesce(
        F.try_parse_url(url, F.lit("HOST")),
        F.nullif(F.regexp_extract(url, HOST_RE, 1), F.lit("")),
    )
    return F.regexp_replace(F.lower(host), WWW, "")


def normalise_domain(url: Column | str) -> Column:
    """Domain key of a credibility record: scheme, ``www.`` and path removed.

    Unlike :func:`extract_domain` it accepts bare domains and keeps ports and
    query strings. NULL or empty input gives NULL.
    """
    bare = F.regexp_replace(F.nullif(col_of(url), F.lit("")), r"(?i)^https?://", "")
    return trim_space(F.lower(F.regexp_replace(F.regexp_replace(bare, WWW, ""), r"/.*$", "")))


def lookup_key(domain: Column | str) -> Column:
    """Key under which a domain is looked up in the credibility dimension."""
    return F.lower(F.regexp_replace(col_of(domain), WWW, ""))


def article_domain(url: Column | str, feed_domain: Column | str) -> Column:
    """Domain of an article: its own host, else its feed's domain."""
    return first_truthy(extract_domain(url), feed_domain)


def article_domain_v1(url: Column | str, feed_domain: Column | str) -> Column:
    """Older rule: the feed's domain, else the article's own host."""
    return first_truthy(feed_domain, extract_domain(url))
