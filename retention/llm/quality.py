"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

A text's features are its words and punctuation runs, the pairs and triples of them, and the
pairs and triples of their shapes (capitals, digits, the punctuation itself, same word as before),
hashed into ``2 ** bits`` columns; a feature's value is its share of the text, so a score is a sparse dot
product, computed as the mean weight of the features that occur.

Only training fits on a sample: at most about ``max_rows`` labelled rows, taken evenly by a
hash of the id. The sample is dealt to ``shards`` learners, each runs FTRL-proximal over its
rows, and the learners' weights are averaged. The weights have a fixed size and are sent to
the scan that scores every whole text.

The intercept is the log odds of the labels, so a text without features scores the share of label 1.

A null text counts as empty, and so has no features. Labels
without an id or a value are left out; of several labels for one id the largest counts. No
labels at all give weights of zero and scores of one half. Repeated rows and ties get equal
scores; empty tables give empty tables. Only id and text are read; ``keep`` hands on all
columns of the documents.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retention.llm.text import blocks, out_schema, restored, two_columns, with_rows

BITS = 18
MAX_ROWS = 20_000
SHARDS = 8
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 0.01, 1e-4, 1e-3
THRESHOLD = 0.3
SCALE = 8.0
KEPT_WORDS = 300_000
TOKEN = re.compile(r"\w+|[^\w\s]+")
LOWER, TITLE, UPPER, MIXED, DIGITS, SAME = range(1, 7)
ONE, TWO, THREE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
FOUR = np.uint64(0xD6E8FEB86659FD93)


def _shape(word: str) -> int:
    if not (word[0].isalnum() or word[0] == "_"):
        return 16 + (zlib.crc32(word.encode()) & 0xFFFFF)
    if word.islower():
        return LOWER
    if len(word) > 1 and word.isupper():
        return UPPER
    return TITLE if word.istitle() else DIGITS if word.isdigit() else MIXED


class Features(dict):
    """Word -> its hash and shape in one number; texts -> columns."""

    def __init__(self, bits: int):
        super().__init__()
        self.shift = np.uint64(64 - bits)

    def __missing__(self, word: str) -> int:
        value = zlib.crc32(word.encode()) << 24 | _shape(word)
        if len(self) < KEPT_WORDS:
            self[word] = value
        return value

    def columns(self, text: str) -> np.ndarray:
        """The column of every n-gram of a text, with repetitions."""
        words = TOKEN.findall(text)
        if not words:
            return np.zeros(0, np.int64)
        packed = np.fromiter(map(self.__getitem__, words), np.uint64, len(words))
        word = packed >> np.uint64(24)
        shape = packed & np.uint64(0xFFFFFF)
        shape[1:][word[1:] == word[:-1]] += np.uint64(SAME << 21)
        with np.errstate(over="ignore"):
            grams = [word * ONE]
            for part, kind in ((word, FOUR), (shape, THREE)):
                if len(words) > 1:
                    pair = (part[:-1] * TWO + part[1:]) * ONE
                    grams.append(pair * kind)
                    if len(words) > 2:
                        grams.append((pair[:-1] * TWO + part[2:]) * kind)
            return (np.concatenate(grams) >> self.shift).astype(np.int64)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int, float]], size: int, intercept: float, epochs: int = EPOCHS) -> np.ndarray:
    """Weights after ``epochs`` passes over (columns, counts, their sum, label)."""
    z, n = np.zeros(size), np.zeros(size)

    def weights(at):
        zi = z[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zi) <= L1, 0.0, w)

    for _ in range(epochs):
        for at, counts, total, y in rows:
            w, x = weights(at), SCALE * counts.astype(np.float64) / max(1, total)
            p = 1 / (1 + np.exp(-np.clip(intercept + w @ x, -35, 35)))
            g = (p - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(size))


def vector(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct columns, how often each occurs, and the sum: in the narrowest types, since a learner holds all its rows."""
    at, counts = np.unique(columns, return_counts=True)
    narrow = [v.astype(np.min_scalar_type(int(v.max()) if len(v) else 0)) for v in (at, counts)]
    return *narrow, len(columns)


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", may_train: Column | None = None, bits: int = BITS,
    max_rows: int = MAX_ROWS, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
) -> np.ndarray:
    """Weights, the intercept last, learnt from at most about ``max_rows`` labelled documents; ``may_train`` says which labels may be used."""
    size = 1 << bits
    usable = labels.filter(may_train) if may_train is not None else labels
    usable = usable.select(labels[f"`{id_col}`"].alias("key"), labels[f"`{label_col}`"].cast("double").alias("label"))
    usable = usable.dropna().groupBy("key").agg(F.max("label").alias("label"))
    n, positive = usable.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = min(1.0, max_rows / n) if n else 1.0
    intercept = float(np.log((positive + 0.5) / (n - positive + 0.5)))
    order = F.pmod(F.xxhash64("key", F.lit("sample")), F.lit(1 << 40))
    sample = usable.withColumn("order", order).filter(F.col("order") < int(share * (1 << 40)))
    # The hash leaves at most about max_rows rows of 24 bytes: a bounded broadcast.
    rows = two_columns(docs, id_col, text_col).join(F.broadcast(sample), F.col("id") == F.col("key"))
    rows = rows.select((F.col("order") % shards).alias("shard"), "order", "label", "text")

    def learn(group: pd.DataFrame) -> pd.DataFrame:
        features = Features(bits)
        group = group.sort_values(["order", "text"])
        prepared = [(*vector(features.columns(t)), y) for t, y in zip(group["text"], group["label"])]
        return pd.DataFrame({"weights": [ftrl(prepared, size, intercept).astype(np.float32).tobytes()]})

    learnt = rows.groupBy("shard").applyInPandas(learn, "weights binary").collect()  # one vector of fixed size per learner
    vectors = sorted(r["weights"] for r in learnt) or [np.zeros(size, np.float32).tobytes()]
    mean = np.mean([np.frombuffer(v, np.float32) for v in vectors], axis=0, dtype=np.float64)
    return np.append(mean, intercept)


def _scored(source: DataFrame, weights: np.ndarray) -> DataFrame:
    bits = (len(weights) - 1).bit_length() - 1
    shared = source.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, features = shared.value, Features(bits)
        for keys, texts in blocks(batches):
            margins = np.empty(len(texts))
            for i, text in enumerate(texts):
                columns = features.columns(text)
                margins[i] = w[-1] + (SCALE * w[columns].mean() if len(columns) else 0.0)
            yield pa.RecordBatch.from_arrays([keys, pa.array(1 / (1 + np.exp(-np.clip(margins, -35, 35))))], ["id", "score"])

    return source.mapInArrow(run, out_schema(source, score="double"))


def score(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted) of every whole text."""
    out = _scored(two_columns(docs, id_col, text_col), weights)
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumnRenamed("id", id_col)


def keep(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The documents that score at least ``threshold``, with all their columns."""
    out = _scored(with_rows(docs, text_col), weights)
    return restored(out.filter(F.col("score") >= threshold), docs.columns)


def not_held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds != 0
