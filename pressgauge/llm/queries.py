"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pressgauge.llm import (
    bag_minhash, bitplane, bitsliced, brown_lm, compress_tox, divergence, license_join, main_text, oracles, piece_codec, quality_votes, resample,
    splitters, winnow,
)
from pressgauge.llm.common import given

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE = oracles.SQL


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return brown_lm.score_documents(given(spark, sf_dir, "documents"))


@query
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_join.scan_licenses(spark, given(spark, sf_dir, "documents"))


@query
def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_codec.digests(given(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op4_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(given(spark, sf_dir, "pages"))


@query
def op5_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_votes.report(given(spark, sf_dir, "documents"))


@query
def op6_bitplane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane.round_trip(spark, given(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.decontaminate(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))


@query
def op8_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(given(spark, sf_dir, "documents"))


@query
def op9_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_tox.score_documents(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"))


@query
def op10_sampled_splitters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitters.assign_shards(given(spark, sf_dir, "documents"))


@query
def op11_quadtree_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(given(spark, sf_dir, "documents"))


@query
def op12_median_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))


@query
def op13_bitsliced_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitsliced.near_duplicates(given(spark, sf_dir, "documents"))
