"""One runnable query per operator, over the derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions import dates, labels, tactics as tx, text, urls, values
from pressgauge.operators import ads, content, dedup, enrich, quality, queue, tactic_rows
from pressgauge.operators.graph import written
from pressgauge.plans import analyse, analytics, citation, consensus, counters, cues, ingest, marts, signals
from pressgauge.session import configure, scratch_dir
from pressgauge.sinks import tables as sinks
from pressgauge.sources import discovery, enrichment, feeds, responses, seeds, tables, taxonomy
from pressgauge.streaming import jobs
from testbed import tables as T

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Phrases of the given prose, in the form of the discovery themes.
PROSE_THEMES = (
    ("English", ("And the", "of the", "with by"), None),
    ("French", ("que des", "de la"), None),
    ("German", ("nicht", "und die"), None),
    ("French with les", ("que", "elle"), "LES"),
)


def query(fn: Query) -> Query:
    """Register under the function's name; settings are applied before the plan is built.

    Timestamps leave as UTC wall time without a zone, the type the given tables
    have, so a result reads the same whatever zone the caller's process is in.
    """

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(configure(spark), sf_dir)
        zoned = [c for c, kind in df.dtypes if kind == "timestamp"]
        return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

    REGISTRY[fn.__name__] = run
    return fn


def fx(spark: SparkSession, sf_dir: str, *names: str):
    frames = [T.derived(spark, sf_dir, f"fx_{n}") for n in names]
    return frames[0] if len(frames) == 1 else frames


# --- sources ---------------------------------------------------------------


@query
def feed_items(s, d):
    items = feeds.parse_feeds(T.feed_payloads(s, d))
    return items.withColumn("published_at", dates.parse_published("published_raw"))


@query
def feed_items_topn(s, d):
    return feeds.first_items(feeds.parse_feeds(T.feed_payloads(s, d), C.ITEMS_PER_FEED))


def _discovery(s, d):
    return discovery.valid_discovery(discovery.parse_discovery(T.discovery_payloads(s, d)))


@query
def discovery_items(s, d):
    return discovery.v1_discovery_fields(_discovery(s, d))


@query
def discovery_candidates(s, d):
    return discovery.discovery_candidates(_discovery(s, d)).withColumn(
        "published_at", dates.parse_published("published_raw")
    )


@query
def discovery_topk(s, d):
    return discovery.per_run_cut(_discovery(s, d)).select("theme", "fetched_at", "pos", "url", "article_domain")


@query
def enrichment_raw(s, d):
    return enrichment.parse_enrichment(T.corpus_payloads(s, d))


@query
def enrichment_norm(s, d):
    return enrichment.normalise_enrichment(enrichment_raw(s, d))


@query
def enrichment_dedup(s, d):
    return dedup.first_wins(enrichment_norm(s, d), ["domain"], ["payload_no", "pos"]).drop("payload_no", "pos")


@query
def response_fields(s, d):
    parsed = responses.parse_responses(T.responses(s, d))
    return parsed.withColumn("n_tactics", F.size("tactics")).drop("tactics", "raw_output")


@query
def search_term_grid(s, d):
    found = fx(s, d, "ad_nodes").groupBy("term", "country").agg(F.count("*").alias("n"))
    return (
        seeds.search_terms(s)
        .join(found, ["term", "country"], "left")
        .withColumn("nodes", F.coalesce("n", F.lit(0).cast("bigint")))
        .drop("n")
    )


@query
def feed_slice(s, d):
    items = feeds.parse_feeds(T.feed_payloads(s, d))
    batches = []
    for name, start, end in (("A", 0, 9), ("B", 10, None)):
        mine = content.with_feed(items, seeds.feed_slice(seeds.feeds(s), start, end))
        batches.append(
            mine.groupBy("feed_ordinal", "publisher_name").agg(F.count("*").alias("items")).withColumn("batch", F.lit(name))
        )
    return batches[0].unionByName(batches[1])


@query
def articles_with_feed(s, d):
    items = feeds.first_items(feeds.parse_feeds(T.feed_payloads(s, d), C.ITEMS_PER_FEED))
    return content.with_feed(items, seeds.feeds(s))


# --- text, domains, labels, dates -----------------------------------------


@query
def html_to_text(s, d):
    page = T.given(s, d, "pages")
    return page.select(
        "page_id",
        text.html_to_text("html").alias("body_text"),
        F.length(text.strip_markup("html")).alias("content_length_full"),
    )


@query
def content_hash(s, d):
    return T.given(s, d, "documents").select("doc_id", text.content_hash("text").alias("content_hash"))


@query
def detect_language(s, d):
    return T.given(s, d, "documents").select("doc_id", text.detect_language("text").alias("l")).select("doc_id", "l.*")


@query
def truncation(s, d):
    stored = F.substring("text", 1, C.CONTENT_MAX_CHARS)
    return T.given(s, d, "documents").select(
        "doc_id", F.length(stored).alias("content_length"), text.is_truncated(stored).alias("truncated")
    )


@query
def content_min_length(s, d):
    return content.min_length(T.given(s, d, "documents"), "text").select("doc_id", F.length("text").alias("content_length"))


@query
def extract_domain(s, d):
    return fx(s, d, "urls").select("page_id", urls.extract_domain("url").alias("domain"))


@query
def normalise_domain(s, d):
    return fx(s, d, "urls").select(
        "page_id", urls.normalise_domain("url").alias("domain"), urls.lookup_key("url").alias("lookup_key")
    )


@query
def normalise_bias(s, d):
    return fx(s, d, "corpus").select("item_no", labels.normalise_bias("bias").alias("mbfc_bias"))


@query
def normalise_factuality(s, d):
    return fx(s, d, "corpus").select(
        "item_no", labels.normalise_factuality("factual_reporting").alias("mbfc_factuality")
    )


@query
def derive_credibility(s, d):
    return fx(s, d, "labelled").select(
        "domain", labels.derive_credibility("mbfc_bias", "mbfc_factuality").alias("mbfc_credibility")
    )


@query
def coalesce_falsy(s, d):
    return fx(s, d, "corpus").select(
        "item_no", values.first_truthy("source_url_normalized", "url", "domain").alias("chosen")
    )


@query
def coalesce_nullish(s, d):
    return fx(s, d, "corpus").select(
        "item_no", F.coalesce("source_url_normalized", "url", "domain").alias("chosen")
    )


@query
def parse_published(s, d):
    given = fx(s, d, "dates")
    at = F.col("published_at")
    raw = (
        F.when(F.col("form") == 0, F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(F.col("form") == 1, F.concat(F.date_format(at + F.expr("interval 2 hours"), "EEE, d MMM yyyy HH:mm:ss"), F.lit(" +0200")))
        .when(F.col("form") == 2, F.concat(F.date_format(at - F.expr("interval 5 hours"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")))
        .when(F.col("form") == 3, F.date_format(at, "yyyyMMdd'T'HHmmss'Z'"))
        .when(F.col("form") == 4, F.lit("yesterday evening"))
        .otherwise("")
    )
    return given.select("doc_id", raw.alias("raw")).select(
        "doc_id", dates.parse_published("raw").alias("published_at"), dates.date_is_bad("raw").alias("published_bad")
    )


@query
def recent_items(s, d):
    events = T.given(s, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    as_of = events.agg(F.max("ts")).scalar()
    return content.recent(events, "ts", as_of, 1)


# --- candidates -------------------------------------------------------------


@query
def dedup_first_wins(s, d):
    return dedup.first_wins(fx(s, d, "candidates"), ["content_hash"], dedup.ORDER).drop("fetched_at")


@query
def new_candidates(s, d):
    new, _ = dedup.suppress_known(*fx(s, d, "candidates", "known_queue", "known_scans"))
    return new.select("item_pos", "source_type", "content_hash")


@query
def skip_reasons(s, d):
    _, skipped = dedup.suppress_known(*fx(s, d, "candidates", "known_queue", "known_scans"))
    return skipped.select("item_pos", "source_type", "reason")


@query
def new_candidates_v1(s, d):
    candidates, scanned = fx(s, d, "candidates", "known_scans")
    new, _ = dedup.suppress_known(candidates, None, scanned)
    return new.select("item_pos", "source_type", "content_hash")


@query
def run_summary(s, d):
    return dedup.run_outcomes(*fx(s, d, "candidates", "known_queue", "known_scans"))


@query
def theme_matches(s, d):
    return content.theme_matches(T.given(s, d, "documents"), "text", PROSE_THEMES + C.THEMES)


@query
def scan_provenance(s, d):
    rows = fx(s, d, "candidates").withColumns(
        {"advertiser_name": F.col("publisher_name"), "search_term": F.lit("term"), "ad_country": F.lit("US")}
    )
    return content.with_provenance(rows).drop("fetched_at", "phase", "feed_ordinal", "article_url")


# --- ads --------------------------------------------------------------------


@query
def ad_texts(s, d):
    return ads.assemble_ads(fx(s, d, "ad_nodes"))


@query
def ad_fallback(s, d):
    nodes, blocks = fx(s, d, "ad_nodes", "ad_blocks")
    return ads.fallback_ads(blocks, ads.assemble_ads(nodes))


@query
def page_ads(s, d):
    return ads.page_ads(*fx(s, d, "ad_nodes", "ad_blocks"))


@query
def ads_topk(s, d):
    return ads.ads_per_term(page_ads(s, d), seeds.search_terms(s))


@query
def ad_candidates(s, d):
    return ads.ad_candidates(ads_topk(s, d))


ARTICLE_FIELDS = ["source_type", "publisher_name", "publisher_domain", "country", "media_class", "topic_class",
                  "article_url", "article_domain", "headline_text", "phase"]


@query
def all_candidates(s, d):
    every = content.all_candidates(
        articles_with_feed(s, d), discovery.discovery_candidates(_discovery(s, d)), ad_candidates(s, d)
    )
    return every.select(*ARTICLE_FIELDS, "region", "search_term")


def _run_items(s, d, start=0):
    return ingest.collect_run(articles_with_feed(s, d), discovery.discovery_candidates(discovery.per_run_cut(_discovery(s, d))), start)


@query
def ingest_summary(s, d):
    pages, queued, scanned = fx(s, d, "pages", "known_queue", "known_scans")
    return ingest.ingest_summary(_run_items(s, d), pages, queued, scanned)


@query
def queue_candidates(s, d):
    """The whole ingest plan, written to the queue table and read back."""
    pages, queued, scanned = fx(s, d, "pages", "known_queue", "known_scans")
    every = content.all_candidates(
        ingest.article_candidates(_run_items(s, d), pages), ingest.with_queue_constants(ad_candidates(s, d))
    )
    rows = ingest.new_queue_rows(every, queued, scanned)
    path = scratch_dir(s, "queue")
    sinks.append_candidates(rows, path, "r1")
    return s.read.parquet(path).drop("run", "queued_on", "body_text", "published_bad", "fetched_at")


@query
def ad_cards_read(s, d):
    """Ad cards from a landed node table, through its reader."""
    path = scratch_dir(s, "ad-nodes")
    fx(s, d, "ad_nodes").write.parquet(path)
    return ads.assemble_ads(tables.read_ad_nodes(s, path))


@query
def collect_run_later(s, d):
    """Items of a batch that starts behind the first feed: discovery is not its business."""
    return _run_items(s, d, start=10).select("source_type", "article_url", "feed_ordinal", "item_pos", "fetched_at")


@query
def run_counters(s, d):
    """Counters of a run whose every seventh feed and fifth list was cut off in transit."""
    path = scratch_dir(s, "counted-run")
    torn = lambda df, bad: df.withColumn("body", F.when(bad, F.substring("body", 1, 40)).otherwise(F.col("body")))
    hours = F.floor((F.unix_timestamp("fetched_at") - F.lit(1704067200)) / 3600)
    feed = torn(T.feed_payloads(s, d), hours % 7 == 3)
    lists = torn(T.discovery_payloads(s, d), hours % 5 == 1)
    found = {"feeds": counters.counted_feeds(feed), "lists": counters.counted_lists(lists), "ads": (ads.assemble_ads(fx(s, d, "ad_nodes")), None)}
    counters.write_counted(found, path, "r1")
    return s.read.parquet(f"{path}/counters").select("part", "counter", "value")


# --- credibility --------------------------------------------------------------


def _dimension(s, d):
    return fx(s, d, "labelled").withColumn(
        "mbfc_credibility", labels.derive_credibility("mbfc_bias", "mbfc_factuality")
    )


@query
def enrichment_upsert(s, d):
    return enrich.upsert_snapshot(fx(s, d, "old_dimension"), enrichment_dedup(s, d), "domain")


@query
def enrichment_preview(s, d):
    cols = ["domain", "mbfc_bias", "mbfc_factuality", "mbfc_credibility"]
    return enrich.preview(enrichment_upsert(s, d), cols, 5)


@query
def enrichment_count(s, d):
    return enrich.row_count(enrichment_dedup(s, d))


@query
def scans_enriched(s, d):
    return enrich.scans_enriched(fx(s, d, "scans"), _dimension(s, d))


@query
def credibility_lookup(s, d):
    scans = fx(s, d, "scans").withColumn(
        "article_domain", F.when(F.col("doc_id") % 4 == 0, F.lit("WWW.unknown.example")).otherwise(F.col("article_domain"))
    )
    return enrich.credibility_lookup(scans.select("scan_id", "article_domain", "publisher_domain"), _dimension(s, d))


@query
def credibility_lookup_exact(s, d):
    scans = fx(s, d, "scans").select("scan_id", "article_domain")
    return enrich.credibility_lookup(scans, _dimension(s, d), mode="exact")


@query
def enrichment_coverage(s, d):
    return enrich.enrichment_coverage(fx(s, d, "scans"), _dimension(s, d)).select(
        "scan_id", "article_domain", "spi_score"
    )


@query
def score_by_credibility(s, d):
    return enrich.score_by_credibility(scans_enriched(s, d))


# --- responses and tactics ------------------------------------------------------


def _parsed(s, d):
    return responses.parse_responses(T.responses(s, d))


@query
def tactic_vector(s, d):
    vector = _parsed(s, d).select("content_hash", tx.tactic_vector(F.col("tactics")).alias("v"))
    as_text = F.concat_ws("|", F.transform("v", lambda e: F.concat(e["code"], F.lit(":"), e["weight"].cast("string"))))
    return vector.select("content_hash", F.when(F.col("v").isNotNull(), as_text).alias("vector"))


@query
def tactic_rows_(s, d):
    return tactic_rows.flatten_tactics(_parsed(s, d))


@query
def tactic_rows_v1(s, d):
    # an object without label and name is its own label, as JSON; only its presence is compared
    rows = tactic_rows.flatten_tactics(_parsed(s, d), dialect="v1")
    return rows.withColumn(
        "tactic_label", F.when(F.col("tactic_label").startswith("{"), "<object>").otherwise(F.col("tactic_label"))
    )


@query
def code_mismatch(s, d):
    return quality.code_mismatch(_parsed(s, d))


def _items(s, d):
    return dedup.first_wins(fx(s, d, "candidates"), ["content_hash"], dedup.ORDER).select(
        "content_hash",
        "source_type",
        "publisher_name",
        F.col("article_domain").alias("publisher_domain"),
        "article_domain",
        F.lit(C.TAXONOMY_VERSION).alias("taxonomy_version"),
        F.col("publisher_name").alias("advertiser_name"),
        F.lit("term").alias("search_term"),
        F.lit("US").alias("ad_country"),
        F.col("source_type").alias("media_class"),
        F.lit("US").alias("region"),
        F.lit("US").alias("country"),
        F.lit(True).alias("in_distribution"),
        (F.col("fetched_at") + F.expr("interval 1 hour")).alias("answered_at"),
    )


def _analysed(s, d):
    items = _items(s, d)
    scans = analyse.scans_from_responses(
        items, T.responses(s, d).drop("taxonomy_version"), _dimension(s, d), F.col("answered_at")
    )
    return scans.drop("answered_at")


def _written_scans(s, d):
    path = scratch_dir(s, "scans")
    sinks.write_scans(_analysed(s, d), analyse.tactics_from_scans, path, "r1")
    return path


@query
def scans_out(s, d):
    written = s.read.parquet(f"{_written_scans(s, d)}/scans")
    return written.withColumn("n_vector", F.size("tactic_vector")).drop("run", "raw_output", "tactic_vector")


@query
def analysed_weekly(s, d):
    """The domain mart over scans that the analysis itself has written."""
    return marts.domain_integrity_weekly(s.read.parquet(f"{_written_scans(s, d)}/scans"))


@query
def analysis_events(s, d):
    return analyse.status_events(T.responses(s, d)).drop("processed_at")


@query
def tactics_out(s, d):
    return s.read.parquet(f"{_written_scans(s, d)}/tactics").drop("run")


@query
def canonical_scans(s, d):
    current, legacy = fx(s, d, "scans", "legacy_scans")
    columns = ["content_hash", "article_url", "article_domain", "publisher_domain", "headline_text", "published_at",
               "content_length", "analyzer_version", "taxonomy_version", "prompt_version"]
    return content.all_candidates(current, content.canonicalise_v1(legacy)).select(*columns)


@query
def domain_weekly_canonical(s, d):
    """The domain mart over current and older scans together."""
    current, legacy = fx(s, d, "scans", "legacy_scans")
    return marts.domain_integrity_weekly(content.all_candidates(current, content.canonicalise_v1(legacy)))


# --- marts and analytics ----------------------------------------------------------


@query
def domain_integrity_weekly(s, d):
    return marts.domain_integrity_weekly(fx(s, d, "scans"))


@query
def tactic_frequency_weekly(s, d):
    return marts.tactic_frequency_weekly(*fx(s, d, "tactics", "scans"))


@query
def mart_refresh(s, d):
    path = scratch_dir(s, "mart")
    sinks.refresh_mart(marts.domain_integrity_weekly(fx(s, d, "scans")), path)
    return s.read.parquet(path).drop("week_start")


@query
def daily_health(s, d):
    return marts.daily_health(fx(s, d, "scans"))


@query
def version_profile(s, d):
    return marts.version_profile(fx(s, d, "scans"))


@query
def top_tactics_by_publisher(s, d):
    return analytics.top_tactics_by_publisher(*fx(s, d, "tactics", "scans"))


@query
def tactics_by_region(s, d):
    return analytics.tactics_by_region(*fx(s, d, "tactics", "scans"))


@query
def tactic_spi_corr(s, d):
    return analytics.tactic_spi_corr(*fx(s, d, "tactics", "scans"))


@query
def tactic_rollup(s, d):
    return analytics.tactic_rollup(fx(s, d, "tactics"))


@query
def emerging_tactics(s, d):
    return analytics.emerging_tactics(*fx(s, d, "tactics", "scans"))


# --- queue ------------------------------------------------------------------------


@query
def queue_status(s, d):
    return queue.latest_status(fx(s, d, "status_events"))


@query
def queue_depth(s, d):
    return queue.queue_depth(queue.current_queue(*fx(s, d, "queue", "status_events")))


@query
def claim_batch(s, d):
    return queue.claim_batch(queue.current_queue(*fx(s, d, "queue", "status_events")))


@query
def analysis_summary(s, d):
    waiting, events = fx(s, d, "queue", "status_events")
    current = queue.current_queue(waiting, events)
    touched = current.join(events.select("item_id").distinct(), "item_id", "left_semi")
    return queue.analysis_summary(touched, current)


# --- pattern dimension and quality ---------------------------------------------------


def _lines(s, d):
    return taxonomy.split_lines(T.taxonomy_documents(s, d))


@query
def taxonomy_patterns(s, d):
    return taxonomy.parse_patterns(_lines(s, d)).drop("line_no")


@query
def taxonomy_attrs(s, d):
    return taxonomy.pattern_attrs(taxonomy.parse_patterns(_lines(s, d)))


@query
def display_names(s, d):
    return taxonomy.display_names(_lines(s, d))


@query
def tactic_display(s, d):
    names = display_names(s, d).groupBy("pattern_id").agg(F.min("display_name").alias("display_name"))
    return tactic_rows.with_display_name(fx(s, d, "tactics"), names)


@query
def audience_routing(s, d):
    return analytics.audience_counts(fx(s, d, "tactics"), taxonomy.audience_routing(s))


@query
def unknown_codes(s, d):
    return quality.unknown_codes(fx(s, d, "tactics"), taxonomy.parse_patterns(_lines(s, d)))


@query
def orphan_tactics(s, d):
    tactics, scans = fx(s, d, "tactics", "scans")
    return quality.orphans(tactics, marts.in_scope(scans), "scan_id").select("scan_id", "event_id", "tactic_code")


@query
def cascade_delete(s, d):
    tactics, scans = fx(s, d, "tactics", "scans")
    return quality.cascade(tactics, marts.in_scope(scans), "scan_id").select("scan_id", "event_id", "tactic_code")


@query
def constraint_report(s, d):
    return quality.constraint_report(
        fx(s, d, "scans"),
        not_null=["scan_id", "publisher_domain", "spi_score", "region", "in_distribution"],
        accepted={"scan_status": C.SCAN_STATUSES, "region": ("US", "ZA", "INT"), "media_class": ("Broadsheet", "Tabloid")},
        unique=["content_hash", "publisher_domain"],
    )


# --- corpus signals ---------------------------------------------------------------

CUES = ("and the", "of the", "Que", "nicht")


@query
def volume_bursts(s, d):
    events = T.given(s, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return signals.volume_bursts(events)


@query
def citation_cycles(s, d):
    linked = fx(s, d, "linked_pages")
    return signals.citation_cycles(signals.link_edges(linked))


@query
def provenance_void(s, d):
    return signals.provenance_void(T.given(s, d, "pages"))


@query
def template_share(s, d):
    return signals.template_share(T.given(s, d, "documents"))


@query
def cue_hits(s, d):
    return signals.cue_hits(T.given(s, d, "documents"), CUES)


@query
def repetition_ratio(s, d):
    return signals.repetition_ratio(T.given(s, d, "documents"))


@query
def headline_overlap(s, d):
    docs = T.given(s, d, "documents").select(
        "doc_id", F.substring_index("text", "\n", 1).alias("headline"), F.expr("substring(text, locate('\n', text) + 1)").alias("body")
    )
    return signals.headline_overlap(docs, "headline", "body")


@query
def migration_trail(s, d):
    sightings = fx(s, d, "candidates").select(
        "content_hash", F.col("publisher_name").alias("media_class"), F.col("fetched_at").alias("scanned_at")
    )
    return signals.migration_trail(sightings)


@query
def coordinated_text(s, d):
    return consensus.coordinated_text(T.sightings(s, d))


@query
def semantic_consensus(s, d):
    return consensus.semantic_consensus(T.voiced_vectors(s, d))


def _cited(s, d):
    return written(signals.link_edges(fx(s, d, "linked_pages")), "edges")


@query
def citation_rings(s, d):
    return citation.citation_rings(_cited(s, d))


@query
def credibility_steps(s, d):
    edges = _cited(s, d)
    return citation.credibility_steps(edges, _dimension(s, d), citation.citation_rings(edges))


@query
def cue_rates(s, d):
    return cues.cue_rates(T.given(s, d, "documents"), cues.cue_lexicon(fx(s, d, "quoting_patterns")))


@query
def migration_by_cluster(s, d):
    """Which source had a story first, near-identical texts being one story."""
    seen = T.sightings(s, d)
    clusters = consensus.text_clusters(seen)
    placed = seen.withColumn("text_hash", F.sha2("text", 256)).join(clusters, "text_hash")
    sightings = placed.select("cluster_id", F.col("source").alias("media_class"), F.col("seen_at").alias("scanned_at"))
    return signals.migration_trail(sightings, "cluster_id")


# --- streaming ----------------------------------------------------------------------


def _stream_copy(s: SparkSession, df: DataFrame, label: str, files: int, by: str, in_turn: bool = False) -> DataFrame:
    """Land ``df`` as files by ranges of ``by`` and read them back as a stream, one file per batch.

    ``in_turn`` lands one after the other, so the stream also reads them in that order.
    """
    path = scratch_dir(s, f"{label}-in")
    dealt = df.repartitionByRange(files, by)
    if in_turn:
        ranges = scratch_dir(s, f"{label}-ranges")
        dealt.withColumn("range", F.spark_partition_id()).write.partitionBy("range").parquet(ranges)
        for number in range(files):
            part = s.read.schema(df.schema).parquet(f"{ranges}/range={number}")
            part.coalesce(1).sortWithinPartitions(by).write.mode("append").parquet(path)
    else:
        dealt.sortWithinPartitions(by).write.parquet(path)
    return s.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query
def stream_dedup(s, d):
    out = scratch_dir(s, "candidates")
    stream = _stream_copy(s, fx(s, d, "candidates"), "candidates", 3, "item_pos")
    jobs.stream_candidates(stream, out, scratch_dir(s, "ck"), order=["item_pos"]).awaitTermination()
    # which copy survives depends on the order in which files arrive, so only the texts are compared
    return s.read.parquet(out).select("content_hash")


@query
def stream_status(s, d):
    out = scratch_dir(s, "status")
    waiting, events = fx(s, d, "queue", "status_events")
    stream = _stream_copy(s, events, "status", 3, "seq")
    jobs.stream_status(stream, waiting, out, scratch_dir(s, "ck")).awaitTermination()
    return queue.latest_status(s.read.parquet(out))


@query
def stream_transitions(s, d):
    """Claims and responses a minute apart, every batch with its own stretch of time."""
    out = scratch_dir(s, "transitions")
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(mins=F.col("doc_id").cast("int") * 2)
    timed = T.responses(s, d).join(fx(s, d, "texts").select("content_hash", "doc_id"), "content_hash")
    claims = _stream_copy(s, timed.select("content_hash", moment.alias("at")), "claims", 2, "at", True)
    answers = _stream_copy(s, timed.select("content_hash", (moment + F.expr("interval 1 minute")).alias("at"), "body"), "answers", 2, "at", True)
    jobs.stream_transitions(claims, answers, out, scratch_dir(s, "ck")).awaitTermination()
    return s.read.parquet(f"{out}/events").select("content_hash", "step", "status", "error_message")


@query
def stream_scans(s, d):
    out = scratch_dir(s, "stream-scans")
    stream = _stream_copy(s, T.responses(s, d), "responses", 2, "content_hash")
    jobs.stream_scans(stream, out, scratch_dir(s, "ck")).awaitTermination()
    scans = s.read.parquet(f"{out}/scans").select("content_hash", "spi_score", "the_verdict")
    counted = s.read.parquet(f"{out}/tactics").groupBy("scan_id").agg(F.count("*").alias("n"))
    return (
        scans.join(counted, scans["content_hash"] == counted["scan_id"], "left")
        .withColumn("tactics", F.coalesce("n", F.lit(0).cast("bigint")))
        .drop("n", "scan_id")
    )


@query
def stream_scan_rows(s, d):
    """Streamed scans with every column a batch run writes."""
    out = scratch_dir(s, "stream-scans")
    stream = _stream_copy(s, T.responses(s, d).drop("taxonomy_version"), "responses", 2, "content_hash")
    jobs.stream_scans(stream, out, scratch_dir(s, "ck"), _items(s, d), _dimension(s, d), F.col("answered_at")).awaitTermination()
    scans = s.read.parquet(f"{out}/scans")
    return scans.withColumn("n_vector", F.size("tactic_vector")).drop("answered_at", "query_id", "batch_id", "raw_output", "tactic_vector")


@query
def stream_weekly(s, d):
    mart = scratch_dir(s, "stream-mart")
    scans = fx(s, d, "scans")
    stream = _stream_copy(s, scans, "scans", 3, "doc_id")
    jobs.stream_weekly(stream, scratch_dir(s, "store"), mart, scratch_dir(s, "ck")).awaitTermination()
    return s.read.parquet(mart).drop("week_start")


@query
def stream_tactics_weekly(s, d):
    mart = scratch_dir(s, "stream-mart")
    scans, tactics = fx(s, d, "scans", "tactics")
    seen = tactics.join(scans.select("scan_id", F.col("scanned_at").alias("detected_at")), "scan_id")
    facts, rows = _stream_copy(s, scans, "scans", 3, "scanned_at", True), _stream_copy(s, seen, "tactics", 3, "detected_at", True)
    jobs.stream_tactics(facts, rows, scratch_dir(s, "store"), mart, scratch_dir(s, "ck")).awaitTermination()
    return s.read.parquet(mart).drop("week_start")


@query
def tactic_mart_refresh(s, d):
    """The tactic mart, refreshed as a whole and then for its first half again."""
    path = scratch_dir(s, "tactic-mart")
    tactics, scans = fx(s, d, "tactics", "scans")
    mart = marts.tactic_frequency_weekly(tactics, scans)
    sinks.refresh_mart(mart, path)
    sinks.refresh_mart(mart.where("week < timestamp '2024-08-01'"), path)
    return s.read.parquet(path).drop("week_start")


REGISTRY["tactic_rows"] = REGISTRY.pop("tactic_rows_")
