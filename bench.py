"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` picks the data, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` an optional comma-separated list of query names (``all`` for
every one). Each query runs once to warm up and is then timed; results go to
Spark's no-op sink, so whole results are computed but nothing is collected.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pressgauge.session import local_session
from testbed.queries import REGISTRY

HEADLINE = (
    "domain_integrity_weekly",
    "tactic_frequency_weekly",
    "daily_health",
    "html_to_text",
    "detect_language",
    "dedup_first_wins",
    "new_candidates",
    "run_summary",
    "scans_enriched",
    "credibility_lookup",
    "tactic_rows",
    "tactic_vector",
    "top_tactics_by_publisher",
    "tactic_spi_corr",
    "emerging_tactics",
    "theme_matches",
    "ad_texts",
    "feed_items",
    "enrichment_upsert",
    "queue_status",
    "queue_candidates",
    "ingest_summary",
    "stream_dedup",
    "stream_weekly",
)


def run(spark, name: str, sf_dir: str) -> float:
    began = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if chosen == "all" else [n for n in chosen.split(",") if n] or list(HEADLINE)
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    found = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(found.group(1)) if found else None,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
