"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from logwarden.llm import (
    bpe_codec, decontaminate, exact_dedup, html_extract, lm_score, merkle, near_dedup, quality,
    secret_scan, sentencepiece_codec, sharding, toxicity, whitening)
from logwarden.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"))


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest_columns(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_codec.digest_columns(bpe_codec.encode_documents(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_decontamination": op2_decontamination,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_sharding": op4_sharding,
    "op5_secret_scan": op5_secret_scan,
    "op6_lm_score": op6_lm_score,
    "op7_toxicity": op7_toxicity,
    "op8_minhash": op8_minhash,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_html_extraction": op10_html_extraction,
    "op11_merkle": op11_merkle,
    "op12_whitening": op12_whitening,
    "op13_bpe": op13_bpe,
    "pipeline": corpus_pipeline.run,
}
