"""The training-data pipeline: five stages over ``documents``, each on what the one before has kept.

Every stage but the last returns the columns of its input. Between stages the
documents are written to the shared folder and read again, so a lost executor
costs one stage at most and no stage sees another's plan. An empty table gives an
empty one in every stage, and columns are kept whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pressgauge.llm import bag_minhash, compress_tox, piece_codec, quality_votes, winnow
from pressgauge.llm.common import given, stored

#: Rows carry whole texts here: what a task holds of them at once, in Arrow batches and open Parquet row groups, is kept small.
ROW_BOUNDS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500", "parquet.block.size": str(16 << 20)}


def bounded(spark: SparkSession) -> None:
    """Set the session's bounds on rows held at once where the user has set none."""
    for key, value in ROW_BOUNDS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is not likely toxic; null and empty texts score as having no evidence, repeated rows alike."""
    bounded(spark)
    model = compress_tox.fit(docs, given(spark, sf_dir, "labels"))
    return docs.where(compress_tox.toxicity(docs, model) < 0.5)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules, weighed by their accuracies, call good; null and empty texts go, repeated rows are judged alike."""
    bounded(spark)
    return quality_votes.judge(docs, column="__verdict").where("__verdict.kept").drop("__verdict")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, with the least doc_id (null only if all are); null and empty texts are one group."""
    bounded(spark)
    return bag_minhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item stands; null and empty texts have none and stay, as do repeated rows."""
    bounded(spark)
    return winnow.clean(docs, given(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left, encoded and decoded again; a null text is empty, repeated rows each give a row."""
    bounded(spark)
    return piece_codec.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity),
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", pieces),
]

#: SQL can express neither the dictionaries nor the signatures; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
