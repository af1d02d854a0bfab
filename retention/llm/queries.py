"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retention.llm import (
    alignment, bpe, decontaminate, exact_dedup, licenses, line_dedup, lm_mixing, phrases, pii, quality, secret_scan, simhash,
    token_counts,
)

BYTE_BPE = "byte_bpe_multi_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"
BYTE_BPE_JSON = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_mixing.score_texts(table(spark, sf_dir, "documents"))


def quality_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> np.ndarray:
    return quality.train(docs, table(spark, sf_dir, "labels"), may_train=quality.not_held_out())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = quality.score(docs, quality_weights(spark, docs, sf_dir))
    return scored.select("doc_id", (~quality.not_held_out()).alias("held_out"), "score", "predicted")


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(table(spark, sf_dir, "documents"))


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words",
        F.size("starts").cast("long").alias("n_base"),
        F.array_min("starts").alias("first_word"),
        F.array_max("starts").alias("last_word"),
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.remove_lines(table(spark, sf_dir, "documents"), counts=True)


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_BPE))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.alignment_counts(docs, public_tokenizers.path(BYTE_BPE_JSON), public_tokenizers.path(PIECE_BPE))


QUERIES = (
    op1_byte_bpe, op2_lm_scores, op3_quality, op4_personal_data, op5_licenses, op6_exact_dedup, op7_simhash, op8_decontamination,
    op9_line_dedup, op10_token_counts, op11_secret_scan, op12_phrases, op13_alignment,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op6_exact_dedup": exact_dedup.ORACLE,
        "op8_decontamination": decontaminate.ORACLE,
        "op9_line_dedup": line_dedup.ORACLE,
        "op12_phrases": phrases.ORACLE,
    }
