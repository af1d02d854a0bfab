"""The corpus pipeline: quality filter, line dedup, near-dedup, decontamination, token ids.

Every stage is a function of (spark, docs, sf_dir) and works on all rows that the stage before
kept; all but the last return the columns of documents. ``run`` writes each stage's rows to the
shared folder and reads them again for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from retention.llm import bpe, decontaminate, line_dedup, quality, queries, simhash
from retention.sources.staging import stage as written


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep(docs, queries.quality_weights(spark, docs, sf_dir))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many sources share go, except from the document with the least id."""
    return line_dedup.remove_lines(docs)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of linked fingerprints the document with the least id stays."""
    return simhash.first_of_classes(docs)


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words or more in benchmark passages go."""
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, decoded): the token ids of every text and the bytes that they decode to."""
    return bpe.encode_and_decode(docs, public_tokenizers.path(queries.BYTE_BPE))


STAGES = [
    ("quality_classifier", filter_quality),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", dedup_near),
    ("decontamination", decontaminate_documents),
    ("byte_bpe", encode),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
