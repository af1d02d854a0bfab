"""Classification metrics of scored rows: one map-side combined aggregation per question."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import CLASS_NAMES, COMPARISON_METRICS
from ..functions.scalar import safe_ratio
from .curves import ranking_metrics

CONFUSION = ["true_negatives", "false_positives", "false_negatives", "true_positives"]
BASE_METRICS = ["accuracy", "precision", "recall", "f1"]


def confusion_sums(label: str = "label", prediction: str = "prediction") -> list[Column]:
    """The four counts as aggregates. They are always four, also with one class only."""
    cells = zip(CONFUSION, ((0, 0), (0, 1), (1, 0), (1, 1)))
    return [
        F.expr(f"count(CASE WHEN (`{label}` = 1) = {y == 1} AND (`{prediction}` = 1) = {p == 1} THEN 1 END) AS {name}")
        for name, (y, p) in cells
    ]


def confusion_counts(scored: DataFrame, keys: Sequence[str], label="label", prediction="prediction") -> DataFrame:
    return scored.groupBy(*keys).agg(*confusion_sums(label, prediction))


def ratio(num: str, den: str) -> str:
    """SQL text of num / den as doubles, 0 on an empty denominator."""
    return f"(CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE 0.0D END)"


def rate_texts(counts: Sequence[str] = tuple(CONFUSION)) -> dict[str, str]:
    """SQL text of each metric over the four counts, which may be any expressions."""
    tn, fp, fn, tp = (f"({c})" for c in counts)
    specificity, recall = ratio(tn, f"({tn} + {fp})"), ratio(tp, f"({tp} + {fn})")
    return {
        "accuracy": ratio(f"({tp} + {tn})", f"({tn} + {fp} + {fn} + {tp})"),
        "precision": ratio(tp, f"({tp} + {fp})"),
        "recall": recall,
        "f1": ratio(f"(2 * {tp})", f"(2 * {tp} + {fp} + {fn})"),
        "specificity": specificity,
        "sensitivity": recall,
        "balanced_accuracy": f"({specificity} + {recall}) / 2.0D",
    }


def with_rates(counts: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    every = rate_texts()
    return counts.withColumns({n: F.expr(every[n]) for n in (names or every)})


def full_metrics(
    scored: DataFrame,
    keys: Sequence[str] = ("model",),
    label: str = "label",
    prediction: str = "prediction",
    score: str | None = "p",
) -> DataFrame:
    """All metrics per key. A key without scores gets null AUC and average precision."""
    counts = with_rates(confusion_counts(scored, keys, label, prediction))
    if score is None or score not in scored.columns:
        return counts
    ranked = ranking_metrics(scored, keys, score, label).withColumnsRenamed({k: f"__{k}" for k in keys})
    same = F.lit(True)  # a missing key is a key of its own
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return counts.join(ranked, same, "left").drop(*[f"__{k}" for k in keys])


def model_metrics(scored: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """The short form: accuracy, precision, recall, f1_score, auc and the four counts."""
    return full_metrics(scored, keys).select(
        *keys, "accuracy", "precision", "recall", F.col("f1").alias("f1_score"), "auc", *CONFUSION
    )


def segment_metrics(
    scored: DataFrame,
    segment: str,
    names: dict | None = None,
    keys: Sequence[str] = ("model",),
    baseline: str | None = None,
) -> DataFrame:
    """Metrics, churn_rate and count per key and segment value; missing segments are left out.

    ``names`` renames segment values. ``baseline`` leaves out one value, for
    callers that want only the segments that have an encoded column. A column
    that does not exist yields no rows.
    """
    group = [*keys, "segment"]
    if segment not in scored.columns:
        rows = scored.limit(0).withColumn("segment", F.lit(None).cast("string"))
    else:
        value = F.col(segment).cast("string")
        rows = scored.where(value.isNotNull())
        if baseline is not None:
            rows = rows.where(value != baseline)
        shown = value
        for old, new in (names or {}).items():
            shown = F.when(value == str(old), new).otherwise(shown)
        rows = rows.withColumn("segment", shown)
    positives, n = F.col("false_negatives") + F.col("true_positives"), sum_of_counts()
    return full_metrics(rows, group).withColumns({"churn_rate": safe_ratio(positives, n), "count": n})


def sum_of_counts() -> Column:
    tn, fp, fn, tp = (F.col(c) for c in CONFUSION)
    return tn + fp + fn + tp


def classification_report(
    scored: DataFrame,
    keys: Sequence[str] = ("model",),
    class_names: Sequence[str] = tuple(CLASS_NAMES),
) -> DataFrame:
    """(keys…, row, precision, recall, f1, support) for both classes, accuracy and two averages.

    On the accuracy row all three numbers are the accuracy.
    """
    tn, fp, fn, tp = (F.col(c) for c in CONFUSION)
    n = sum_of_counts()

    def one(name, hit, wrong, missed):
        return {
            "row": F.lit(name),
            "precision": safe_ratio(hit, hit + wrong),
            "recall": safe_ratio(hit, hit + missed),
            "f1": safe_ratio(2 * hit, 2 * hit + wrong + missed),
            "support": hit + missed,
        }

    negative = one(class_names[0], tn, fn, fp)
    positive = one(class_names[1], tp, fp, fn)
    accuracy = safe_ratio(tp + tn, n)
    measures = ("precision", "recall", "f1")
    parts = [
        negative,
        positive,
        {"row": F.lit("accuracy"), **{m: accuracy for m in measures}, "support": n},
        {"row": F.lit("macro avg"), **{m: (negative[m] + positive[m]) / F.lit(2.0) for m in measures}, "support": n},
        {
            "row": F.lit("weighted avg"),
            **{
                m: safe_ratio(negative[m] * negative["support"] + positive[m] * positive["support"], n)
                for m in measures
            },
            "support": n,
        },
    ]
    rows = F.array(*[F.struct(*[e.alias(name) for name, e in part.items()]) for part in parts])
    return confusion_counts(scored, keys).select(*keys, F.explode(rows).alias("r")).select(*keys, "r.*")


def metric_title(name: str) -> str:
    return name.replace("_score", "").capitalize()


def comparison_long(metrics: DataFrame, names: Sequence[str] = tuple(COMPARISON_METRICS)) -> DataFrame:
    """(Model, Metric, Value) of the metrics that have a value."""
    present = [n for n in names if n in metrics.columns]
    return (
        metrics.select(F.col("model").alias("Model"), *[F.col(n).cast("double").alias(metric_title(n)) for n in present])
        .unpivot(["Model"], [metric_title(n) for n in present], "Metric", "Value")
        .where(F.col("Value").isNotNull())
    )


def comparison_table(
    metrics: DataFrame,
    names: Sequence[str] = tuple(COMPARISON_METRICS),
    sort_by: str = "f1_score",
    ascending: bool = False,
    fill: float | None = 0.0,
) -> DataFrame:
    """One row per model with one column per metric, in the order of ``sort_by``.

    The metric table has one row per model, so the sort is over models only.
    """
    present = [n for n in names if n in metrics.columns]
    wide = metrics.select(
        F.col("model").alias("Model"), *[F.col(n).cast("double").alias(metric_title(n)) for n in present]
    )
    if sort_by in present:
        c = F.col(metric_title(sort_by))
        wide = wide.orderBy(c.asc_nulls_last() if ascending else c.desc_nulls_last(), "Model")
    return wide if fill is None else wide.na.fill(fill)
