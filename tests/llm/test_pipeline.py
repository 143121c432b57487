"""The pipeline: each stage against the operator it calls, and awkward or empty input."""

import corpus_pipeline as pipeline
from pressgauge.llm import compress_tox, quality_votes, winnow
from pressgauge.llm.queries import REGISTRY

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_what_their_operators_say(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels, benchmark = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("labels", "benchmark"))
    columns = docs.columns
    out = {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF_DIR).cache()
        out[name] = (before, docs)
    kept = {n: {r.doc_id for r in after.select("doc_id").collect()} for n, (_, after) in out.items()}
    assert all(after.columns == columns for n, (_, after) in out.items() if n != "sentencepiece")
    before = out["toxicity"][0]
    assert kept["toxicity"] == {r.doc_id for r in compress_tox.score_documents(before, labels).where("predicted = 0").collect()}
    before = out["quality rules"][0]
    assert kept["quality rules"] == {r.doc_id for r in quality_votes.report(before).where("kept").collect()}
    before = out["decontamination"][0]
    assert kept["decontamination"] == {r.doc_id for r in winnow.decontaminate(before, benchmark).where("not contaminated").collect()}
    assert kept["sentencepiece"] == kept["decontamination"]
    assert {r.doc_id for r in pipeline.run(spark, SF_DIR).collect()} == kept["sentencepiece"]


def test_stages_on_awkward_and_empty_tables(spark, hostile, nothing):
    awkward = hostile.selectExpr("doc_id", "text", "cast(null as string) lang", "score as source", "cast(null as bigint) n_chars")
    for docs in (awkward, nothing):
        for name, stage in pipeline.STAGES:
            after = stage(spark, docs, SF_DIR)
            assert name == "sentencepiece" or after.columns == docs.columns
            assert after.count() <= docs.count()


def test_registered(spark):
    assert {n for n in driver.queries() if n.startswith("op")} == set(REGISTRY)
    assert sorted(int(n[2:].split("_")[0]) for n in REGISTRY) == list(range(1, 14))
    assert driver.queries()["pipeline"] is pipeline.run
