"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from termloom.llm import decontaminate, lm, minhash, mixture, negatives, oracle, packing, quality, suffix
from termloom.llm import token_counts, topk, toxicity, urls, whitening
from termloom.llm.tables import read, ready

TOKEN_LIMIT = 2048

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return minhash.near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    counted = token_counts.tokens_of(token_counts.prefix_counts(read(spark, sf_dir, "documents")))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return quality.score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return lm.score_texts(read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return packing.pack(read(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return suffix.repeated_bytes(read(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return toxicity.score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return topk.top_k(read(spark, sf_dir, "embeddings"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    ready(spark)
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.taken(read(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Query] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_token_counts": op2_token_counts,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_decontamination": op4_decontamination,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_packing": op6_packing,
    "op7_url_filter": op7_url_filter,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_top_k": op10_top_k,
    "op11_whitening": op11_whitening,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_mix": op13_source_mix,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLE: dict[str, str] = {
    "op4_decontamination": oracle.OP4,
    "op10_top_k": oracle.OP10,
    "op12_hard_negatives": oracle.OP12,
    "op13_source_mix": oracle.OP13,
}
if corpus_pipeline.ORACLE_SQL is not None:
    LLM_ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
