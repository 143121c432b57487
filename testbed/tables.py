"""The derived tables as Spark DataFrames, and the payloads packed from them."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from testbed.shared import TABLES, with_clause

GIVEN = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


_SCHEMAS: dict[str, StructType] = {}


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its schema is inferred from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spark_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run portable SQL against the given tables below ``sf_dir``."""
    text = re.sub(r"\{SHA\}\(([^()]*)\)", r"sha2(\1, 256)", with_clause(sql))
    used = [name for name in GIVEN if "{" + name + "}" in text]
    return spark.sql(text, **{name: given(spark, sf_dir, name) for name in used})


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    assert name in TABLES, name
    return spark_sql(spark, sf_dir, f"select * from {name}")


def _xml(text: Column) -> Column:
    for plain, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def _in_order(position: str, text: Column, sep: str) -> Column:
    packed = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), text.alias("t"))))
    return F.array_join(F.transform(packed, lambda x: x["t"]), sep)


def feed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed feeds: four items each, in RSS 2.0, Atom or RDF 1.0."""
    items = derived(spark, sf_dir, "fx_feed_items")
    feeds = derived(spark, sf_dir, "fx_feeds").select("ordinal", "feed_url")
    title, url = _xml(F.col("title")), _xml(F.col("url"))
    rfc822 = F.concat(F.date_format("published_at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    iso = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rss = F.concat(
        F.lit("<item><title>"), title, F.lit("</title><link>"), url,
        F.lit("</link><pubDate>"), rfc822, F.lit("</pubDate></item>"),
    )
    atom = F.concat(
        F.lit('<entry><title type="text">'), title, F.lit('</title><link rel="self" href="http://self.example/"/>'),
        F.lit('<link rel="alternate" href="'), url, F.lit('"/><published>'), iso, F.lit("</published></entry>"),
    )
    rdf = F.concat(
        F.lit("<item><title>"), title, F.lit("</title><link>"), url,
        F.lit("</link><dc:date>"), iso, F.lit("</dc:date></item>"),
    )
    entry = F.when(F.col("dialect") == 0, rss).when(F.col("dialect") == 1, atom).otherwise(rdf)
    packed = items.groupBy("ordinal", "run_no", "fetched_at", "dialect").agg(
        _in_order("pos", entry, "").alias("inner")
    )
    head = '<?xml version="1.0"?>'
    body = (
        F.when(
            F.col("dialect") == 0,
            F.concat(F.lit(head + '<rss version="2.0"><channel><title>c</title><link>http://c.example/</link>'), "inner", F.lit("</channel></rss>")),
        )
        .when(
            F.col("dialect") == 1,
            F.concat(F.lit(head + '<feed xmlns="http://www.w3.org/2005/Atom"><title>c</title><link href="http://c.example/"/>'), "inner", F.lit("</feed>")),
        )
        .otherwise(
            F.concat(
                F.lit(head + '<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel><title>c</title><link>http://c.example/</link></channel>'),
                "inner",
                F.lit("</rdf:RDF>"),
            )
        )
    )
    return packed.join(feeds, "ordinal").select("feed_url", "fetched_at", body.alias("body"))


def discovery_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed discovery lists: five articles each; tone is a number, a string or missing."""
    d = derived(spark, sf_dir, "fx_discovery")
    plain = F.struct(
        "url",
        F.col("listed_domain").alias("domain"),
        "title",
        F.date_format("seen_at", "yyyyMMdd'T'HHmmss'Z'").alias("seendate"),
        F.col("source_language").alias("language"),
    )
    opened = F.regexp_replace(F.to_json(plain), r"\}$", "")
    tone = (
        F.when(F.col("tone_kind") == 0, F.concat(F.lit(',"tone":'), F.col("tone").cast("string")))
        .when(F.col("tone_kind") == 1, F.concat(F.lit(',"tone":"'), F.col("tone").cast("string"), F.lit('"')))
        .otherwise("")
    )
    packed = d.withColumn("payload", F.floor(F.col("page_id") / 5)).groupBy(
        "payload", "theme_ordinal", "theme", "fetched_at"
    )
    return packed.agg(_in_order("pos", F.concat(opened, tone, F.lit("}")), ",").alias("inner")).select(
        "theme_ordinal",
        "theme",
        "fetched_at",
        F.concat(F.lit('{"articles":['), "inner", F.lit("]}")).alias("body"),
    )


def corpus_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed credibility corpus: JSON arrays of up to fifty records."""
    c = derived(spark, sf_dir, "fx_corpus")
    record = F.to_json(
        F.struct("source_url_normalized", "url", "domain", "bias", "factual_reporting", "country")
    )
    return (
        c.withColumn("payload_no", F.floor(F.col("item_no") / 50))
        .groupBy("payload_no")
        .agg(_in_order("item_no", record, ",").alias("inner"))
        .select("payload_no", F.concat(F.lit("["), "inner", F.lit("]")).alias("body"))
    )


#: Bodies that give no scan: no JSON, null, and scores that no integer column holds.
FAULTY = ("upstream error", "null", '{"spi_score":1e12}', '{"spi_score":"abc"}', '{"spi_score":1.5}')


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed model responses: JSON bodies with every shape of ``tactics``."""
    objects = derived(spark, sf_dir, "fx_tactic_objects")
    names = ("code", "label", "name", "tactic_code", "severity", "evidence", "excerpt")
    as_object = F.to_json(F.struct(*[F.col(f"o_{n}").alias(n) for n in names]))
    element = F.when(F.col("is_text"), F.concat(F.lit('"'), "text_value", F.lit('"'))).otherwise(as_object)
    lists = objects.groupBy("content_hash").agg(_in_order("event_id", element, ",").alias("listed"))
    parts = derived(spark, sf_dir, "fx_response_parts").join(lists, "content_hash", "left")
    tactics = (
        F.when(F.col("shape") == "empty", F.lit(',"tactics":[]}'))
        .when(F.col("shape") == "scalar", F.lit(',"tactics":"none"}'))
        .when(F.col("shape") == "array", F.concat(F.lit(',"tactics":['), F.coalesce("listed", F.lit("")), F.lit("]}")))
        .otherwise(F.lit("}"))
    )
    head = F.to_json(
        F.struct(F.lit("r").alias("kind"), "spi_score", "the_play", "emotional_targets", "blind_spots", "the_verdict")
    )
    body = F.when(F.col("broken"), F.get(F.array(*map(F.lit, FAULTY)), F.col("fault"))).otherwise(
        F.concat(F.regexp_replace(head, r"\}$", ""), tactics)
    )
    return parts.select("content_hash", "taxonomy_version", body.alias("body"))


def taxonomy_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pattern-definition documents: headings, patterns with their description, then a display list."""
    p = derived(spark, sf_dir, "fx_patterns")
    section = F.when(
        F.col("place") % 50 == 0,
        F.concat(F.lit("# ====\n# SECTION X: "), "section", F.lit("\n# ====\n\n")),
    ).otherwise("")
    subsection = F.when(F.col("place") % 25 == 0, F.concat(F.lit("## "), "subsection", F.lit("\n\n"))).otherwise("")
    enhanced = F.when(
        F.col("enhanced_layer").isNotNull(),
        F.concat(F.lit(" Enhanced by Layer "), F.col("enhanced_layer").cast("string"), F.lit(': "'), "enhanced_name", F.lit('" - more.')),
    ).otherwise("")
    detection = F.when(F.col("detection").isNotNull(), F.concat(F.lit(" Detection: "), "detection")).otherwise("")
    entry = F.concat(
        section, subsection, "pattern_id", F.lit(" | "), "name", F.lit("\n"), "base_text", enhanced, detection, F.lit("\n")
    )
    shown = F.when(
        F.col("display_name").isNotNull(),
        F.concat(
            F.lit("# "), F.rpad("display_name", 30, " "), F.lit("→ "), "pattern_id",
            F.when(F.col("enhanced"), " (enhanced)").otherwise("           "), F.lit(" → Layer "), "source_layer",
        ),
    )
    return (
        p.groupBy("file_no")
        .agg(_in_order("place", entry, "\n").alias("a"), _in_order("place", shown, "\n").alias("b"))
        .select(
            F.concat(F.lit("doc"), F.col("file_no").cast("string")).alias("path"),
            F.concat("a", F.lit("\n# NAMES\n"), "b", F.lit("\n")).alias("body"),
        )
    )


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with the hour they were seen, eighty an hour, each third one ten days later."""
    hour = F.floor(F.col("doc_id") / 80).cast("int") + F.when(F.col("doc_id") % 3 == 0, 240).otherwise(0)
    seen = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(hours=hour)
    return given(spark, sf_dir, "documents").select("doc_id", "text", "source", seen.alias("seen_at"))


def voiced_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given vectors, and echoes of them by other voices: mixed with the next vector, more with every echo.

    A third of the echoes are of one vector.
    """
    vectors = given(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    n = vectors.agg(F.count("*")).scalar()
    echo = vectors.select((F.col("vec_id") + n).alias("vec_id"), (F.col("vec_id") % 7).cast("int").alias("label"), F.col("vec_id").alias("own"))
    echo = echo.where("own % 4 > 0").withColumn("of", F.when(F.col("own") % 3 == 0, 0).otherwise(F.col("own") - F.col("own") % 4))
    base = vectors.select(F.col("vec_id").alias("of"), F.col("embedding").alias("x"))
    other = vectors.select(F.col("vec_id").alias("own"), F.col("embedding").alias("y"))
    mixed = F.zip_with("x", F.transform("y", lambda v: v * (F.col("own") % 4) * F.lit(0.125)), lambda a, b: a + b)
    return vectors.unionByName(echo.join(base, "of").join(other, "own").select("vec_id", "label", mixed.alias("embedding")))
