"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from pressgauge.operators import dedup, enrich
from pressgauge.plans import ingest, marts
from pressgauge.session import scratch_dir
from testbed.queries import REGISTRY

EAGER = {"queue_candidates", "scans_out", "tactics_out", "analysed_weekly", "mart_refresh", "stream_dedup", "stream_status", "stream_scans", "stream_weekly", "stream_transitions",
         "stream_scan_rows", "stream_tactics_weekly", "tactic_mart_refresh", "coordinated_text", "semantic_consensus", "citation_rings", "credibility_steps",
         "migration_by_cluster", "run_counters", "ad_cards_read"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - EAGER))
def test_no_python_and_no_cross_products(spark, sf_dir, name):
    plan = plan_of(REGISTRY[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """A wide scan table and a dimension on disk."""
    base = str(tmp_path_factory.mktemp("plans"))
    spark.sql(
        """select cast(id as string) as scan_id, sha2(cast(id as string), 256) as content_hash, concat('d', id % 50) as article_domain,
             concat('d', id % 50) as publisher_domain, 'n' as publisher_name, 'm' as media_class, 'r' as region, 'c' as country,
             'v' as taxonomy_version, cast(id % 100 as int) as spi_score, 'success' as scan_status, true as in_distribution,
             timestamp '2024-01-01 00:00:00' as scanned_at, repeat('x', 50) as body_text, '{}' as raw_output,
             0 as fetched_at, 0 as phase, 0 as feed_ordinal, id as item_pos from range(2000)"""
    ).write.parquet(f"{base}/scans")
    spark.sql(
        "select concat('d', id) as domain, 'Left' as mbfc_bias, 'High' as mbfc_factuality, 'HIGH' as mbfc_credibility from range(40)"
    ).write.parquet(f"{base}/dim")
    return spark.read.parquet(f"{base}/scans"), spark.read.parquet(f"{base}/dim")


def test_mart_reads_only_what_it_needs(stored):
    scans, _ = stored
    plan = plan_of(marts.domain_integrity_weekly(scans))
    schema = re.search(r"ReadSchema: struct<([^>]*)", plan).group(1)
    assert "body_text" not in schema and "raw_output" not in schema and "content_hash" not in schema
    assert "EqualTo(scan_status,success)" in plan and "IsNotNull(spi_score)" in plan
    assert plan.count("Exchange") == 1


def test_hot_keys_are_cut_before_the_exchange(stored):
    scans, _ = stored
    plan = plan_of(dedup.first_wins(scans, ["content_hash"], dedup.ORDER))
    limits = re.findall(r"WindowGroupLimit .*?(Partial|Final)", plan)
    assert sorted(limits) == ["Final", "Partial"]
    assert plan.index("Partial") > plan.index("Exchange hashpartitioning(content_hash")


def test_dedup_and_known_check_share_one_exchange_of_candidates(stored):
    scans, _ = stored
    known = scans.select("content_hash")
    plan = plan_of(ingest.new_queue_rows(scans, known, known))
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(wide) == 1  # candidates once; the histories are small here and broadcast without an aggregate
    assert "HashAggregate" not in plan


def test_dimension_is_broadcast_by_size_and_not_by_hint(spark, stored):
    scans, dim = stored
    joined = enrich.scans_enriched(scans, dim)
    assert "BroadcastHashJoin" in plan_of(joined)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = enrich.scans_enriched(scans, dim)
        assert "SortMergeJoin" in plan_of(large) and "Broadcast" not in plan_of(large)
        assert sorted(map(repr, large.collect())) == sorted(map(repr, joined.collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_page_text_is_computed_once(spark):
    pages = spark.createDataFrame([("u", "<p>x</p>")], "url string, html string").repartition(2)
    items = spark.createDataFrame([("u",)], "article_url string")
    plan = plan_of(ingest.with_page_text(items, pages))
    assert plan.count("<script") == 1


def test_no_broadcast_hint_in_the_library():
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    for path in [*root.glob("pressgauge/**/*.py"), *root.glob("testbed/*.py")]:
        if path.parent.name == "llm":
            continue  # fits models on the driver; it bounds and documents what it collects
        source = path.read_text()
        if path.name == "partials.py":  # the weeks of a batch, bounded by the calendar
            source = source.replace(".distinct().collect()]", "", 1)
        assert not re.search(r"broadcast\(|localCheckpoint|crossJoin|\.rdd\b|toPandas|\.collect\(\)", source) or path.name == "check.py", path


def test_scratch_folder_follows_the_cluster_setting(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_skewed_join_key_gives_the_same_mart(spark):
    """One scan holds a third of all tactic rows; adaptive execution must split it and keep the result."""
    scans = spark.sql(
        """select cast(id as string) as scan_id, 'm' as media_class, 'r' as region, cast(id % 100 as int) as spi_score,
           'success' as scan_status, true as in_distribution, timestamp '2024-01-01 00:00:00' as scanned_at from range(500)"""
    )
    tactics = spark.sql(
        """select cast(if(id % 3 = 0, 7, id % 500) as string) as scan_id, concat('F', id % 5) as tactic_code,
           repeat('l', 40) as tactic_label, 'v' as taxonomy_version from range(60000)"""
    ).repartition(6)
    want = sorted(map(repr, marts.tactic_frequency_weekly(tactics, scans).collect()))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        skewed = marts.tactic_frequency_weekly(tactics, scans)
        assert sorted(map(repr, skewed.collect())) == want
        assert "skew=true" in plan_of(skewed)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_functions_do_not_depend_on_the_session_zone_default(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.range(1).select(F.date_format(F.timestamp_seconds(F.lit(0)), "HH:mm")).first()[0] == "00:00"


def test_history_is_neither_shuffled_nor_aggregated(spark, tmp_path):
    """Bucketed histories are read in place by the joins that suppress known content."""
    from pressgauge.sinks.tables import append_history

    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in keys}
    names = ["held_queue", "held_scans"]
    hashes = lambda low, high: spark.range(low, high).selectExpr("concat('h', id) as content_hash")
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        append_history(hashes(0, 300), names[0], str(tmp_path / "q"), 4)
        append_history(hashes(250, 300), names[0], str(tmp_path / "q"), 4)  # a later run, with repeats
        append_history(hashes(200, 500), names[1], str(tmp_path / "s"), 4)
        queued, scanned = (spark.table(n) for n in names)
        hashes(100, 700).unionAll(hashes(100, 120)).write.parquet(str(tmp_path / "c"))
        candidates = spark.read.parquet(str(tmp_path / "c"))
        new, skipped = dedup.suppress_known(candidates, queued, scanned)
        for df, shuffles, count in ((new, 1, 200), (skipped, 2, 420)):
            plan = plan_of(df)
            assert plan.count("Bucketed: true") >= 2 and "Aggregate" not in plan
            assert len(re.findall(r"Exchange hashpartitioning", plan)) <= shuffles  # the candidates alone
            assert df.count() == count
        assert {(r.reason, r["count"]) for r in skipped.groupBy("reason").count().collect()} == {("queued", 220), ("scanned", 200)}
        judged = dedup.with_reason(candidates, queued, scanned)
        assert {(r.reason, r["count"]) for r in judged.groupBy("reason").count().collect()} == {("queued", 220), ("scanned", 200), (None, 200)}
        assert "Aggregate" not in plan_of(judged)
    finally:
        for n in names:
            spark.sql(f"drop table if exists {n}")
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_the_files_of_a_queue_follow_its_days(spark, tmp_path):
    from pressgauge.sinks import tables as sinks

    rows = spark.sql("select id, timestamp '2024-01-01 00:00:00' + make_dt_interval(cast(id % 12 as int)) as fetched_at from range(0, 1200, 1, 8) union all select -1, null")
    sinks.append_candidates(rows, str(tmp_path), "r1")
    days = [p for p in (tmp_path / "run=r1").iterdir() if p.name.startswith("queued_on=")]
    assert len(days) == 13 and sum(len(list(p.glob("*.parquet"))) for p in days) <= 2 * 13
    assert spark.read.parquet(str(tmp_path)).count() == 1201
