"""Feed payloads (RSS 2.0, Atom, RDF 1.0) to article rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.values import first_truthy

_LINK = "struct<_VALUE:string,_href:string,_rel:string>"
_ITEM = (
    f"struct<title:struct<_VALUE:string>,link:array<{_LINK}>,"
    "pubDate:string,published:string,updated:string>"
)
# One schema covers the dialects: RSS nests items in the channel, Atom calls
# them entries, RDF puts them beside the channel.
FEED_SCHEMA = f"channel struct<item:array<{_ITEM}>>, entry array<{_ITEM}>, item array<{_ITEM}>"


def _item_url(links: Column) -> Column:
    usable = F.filter(links, lambda x: x["_rel"].isNull() | (x["_rel"] == "alternate"))
    link = F.get(usable, F.lit(0))
    return first_truthy(link["_VALUE"], link["_href"], F.lit(""))


def parse_feeds(payloads: DataFrame, max_items: int | None = None) -> DataFrame:
    """``payloads(feed_url, fetched_at, body)`` to one row per item.

    ``pos`` counts items from 1 in document order. ``max_items`` cuts the item
    array before it is exploded; leave it out to keep every item. A body that
    is no feed gives no rows.
    """
    doc = F.from_xml("body", FEED_SCHEMA)
    items = F.coalesce("doc.item", "doc.channel.item", "doc.entry")
    if max_items is not None:
        items = F.slice(items, 1, max_items)
    exploded = (
        payloads.select("feed_url", "fetched_at", doc.alias("doc"))
        .select("feed_url", "fetched_at", F.posexplode(items).alias("idx", "entry"))
    )
    none = F.lit(None).cast("string")
    return exploded.select(
        "feed_url",
        "fetched_at",
        (F.col("idx") + 1).alias("pos"),
        F.coalesce("entry.title._VALUE", F.lit("")).alias("title"),
        _item_url(F.col("entry.link")).alias("url"),
        first_truthy("entry.pubDate", "entry.published", "entry.updated", none).alias("published_raw"),
    )


def first_items(items: DataFrame, n: int = C.ITEMS_PER_FEED) -> DataFrame:
    """The first ``n`` items of each payload, then those with a URL.

    The cut comes first, so a payload may keep fewer than ``n`` rows.
    """
    return items.filter((F.col("pos") <= n) & (F.col("url") != ""))
