"""What the stages of the pipeline hold in a Python worker, and what they send to it."""

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from edges import odd_table
from retention.llm import bpe, quality, text

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_a_learner_holds_five_bytes_per_feature():
    rng = np.random.default_rng(1)
    columns = rng.integers(0, 1 << quality.BITS, 3000)
    at, counts, total = quality.vector(columns)
    assert at.nbytes + counts.nbytes <= 5 * len(at) and total == 3000
    want, n = np.unique(columns, return_counts=True)
    assert (at == want).all() and (counts == n).all()
    assert quality.vector(np.zeros(70_000, np.int64))[1].tolist() == [70_000]
    assert quality.vector(np.zeros(0, np.int64))[2] == 0


def test_a_kept_row_is_sent_with_its_text_once(spark):
    docs = odd_table(spark).withColumn("number", F.lit(7))
    sent = text.with_rows(docs, "text")
    assert dict(sent.dtypes)["text"] == "int"
    weights = np.append(np.random.default_rng(2).normal(size=1 << quality.BITS), 0.1)
    kept = quality.keep(docs, weights)
    scores = quality.score(docs, weights).filter("score >= 0.3")
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert kept.count() == scores.count()
    assert sorted(map(str, kept.select("doc_id").collect())) == sorted(map(str, scores.select("doc_id").collect()))
    assert kept.exceptAll(docs).count() == 0
    assert quality.keep(docs, weights, 0.0).exceptAll(docs).count() == docs.exceptAll(quality.keep(docs, weights, 0.0)).count() == 0
    assert quality.keep(docs, weights, 0.0, "number").exceptAll(docs).count() == 0  # no string
    assert quality.keep(docs.limit(0), weights).collect() == []


def test_encoding_and_decoding_take_one_worker(spark):
    docs = odd_table(spark)
    once = bpe.encode_and_decode(docs, RANKS)
    twice = bpe.decode(bpe.encode(docs, RANKS), RANKS)
    assert once.schema == twice.schema
    assert once.exceptAll(twice).count() == twice.exceptAll(once).count() == 0
    for df in (once, bpe.digests(docs, RANKS)):
        assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
