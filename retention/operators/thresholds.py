"""Threshold sweeps and optima. The scored rows are read once, whatever the grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MATRIX_THRESHOLDS, THRESHOLD_METRICS, THRESHOLDS
from ..sources.staging import broadcast_if_small
from .curves import ROWS_PER_RANGE, running_counts
from .metrics import CONFUSION, rate_texts, with_rates

SWEEP_METRICS = ["precision", "recall", "f1", "specificity", "balanced_accuracy"]


def predict_at(score: Column, threshold) -> Column:
    """1 where the score reaches the threshold."""
    return (score >= threshold).cast("int")


def threshold_sweep(
    scored: DataFrame,
    keys: Sequence[str] = ("model",),
    thresholds: Sequence[float] | None = None,
    score: str = "p",
    label: str = "label",
) -> DataFrame:
    """Counts and metrics per key and threshold.

    Each row falls into one bucket between neighbouring thresholds, so the
    aggregation holds at most len(thresholds) + 1 rows per key, and the counts
    at a threshold are the sum of the buckets from it on.
    """
    grid = sorted(set(THRESHOLDS if thresholds is None else thresholds))
    keys = list(keys)
    usable = scored.where(F.col(score).isNotNull() & ~F.isnan(score))
    bucketed = Bucketizer(
        splits=[float("-inf"), *grid, float("inf")], inputCol=score, outputCol="bucket"
    ).transform(usable)
    positive = F.col(label) == 1
    counts = bucketed.groupBy(*keys, F.col("bucket").cast("int").alias("bucket")).agg(
        F.count(F.when(positive, 1)).alias("pos"), F.count(F.when(~positive, 1)).alias("neg")
    )
    per_key = counts.groupBy(*keys).agg(
        F.collect_list(F.struct("bucket", "pos", "neg")).alias("buckets")  # bounded by the grid
    )
    at = per_key.select(
        *keys,
        "buckets",
        F.posexplode(F.array(*[F.lit(float(t)) for t in grid])).alias("i", "threshold"),
    )
    zero = F.lit(0).cast("long")

    def total(name: str, from_threshold: bool) -> Column:
        def add(acc, b):
            if not from_threshold:
                return acc + b[name]
            return acc + F.when(b["bucket"] > F.col("i"), b[name]).otherwise(zero)

        return F.aggregate("buckets", zero, add)

    summed = at.select(
        *keys,
        "threshold",
        total("pos", True).alias("true_positives"),
        total("neg", True).alias("false_positives"),
        total("pos", False).alias("n_pos"),
        total("neg", False).alias("n_neg"),
    ).select(
        *keys,
        "threshold",
        "true_positives",
        "false_positives",
        (F.col("n_neg") - F.col("false_positives")).alias("true_negatives"),
        (F.col("n_pos") - F.col("true_positives")).alias("false_negatives"),
    )
    return with_rates(summed, SWEEP_METRICS)


def best_on_grid(
    sweep: DataFrame, keys: Sequence[str] = ("model",), metrics: Sequence[str] = tuple(THRESHOLD_METRICS)
) -> DataFrame:
    """(keys…, metric, threshold, score): highest value per metric, lowest threshold on a tie."""
    unknown = set(metrics) - set(THRESHOLD_METRICS)
    if unknown:
        raise ValueError(f"Unsupported metric: {sorted(unknown)[0]}")
    return (
        sweep.unpivot([*keys, "threshold"], list(metrics), "metric", "score")
        .groupBy(*keys, "metric")
        .agg(F.min(F.struct((-F.col("score")).alias("minus"), F.col("threshold"))).alias("best"))
        .select(*keys, "metric", "best.threshold", (-F.col("best.minus")).alias("score"))
    )


def optimal_thresholds(
    scored: DataFrame,
    keys: Sequence[str] = ("model",),
    metrics: Sequence[str] = tuple(THRESHOLD_METRICS),
    thresholds: Sequence[float] | None = None,
) -> DataFrame:
    """Best grid threshold per key and metric, from one sweep."""
    return best_on_grid(threshold_sweep(scored, keys, thresholds), keys, metrics)


def best_over_scores(
    scored: DataFrame,
    metrics: str | Sequence[str] = "f1",
    keys: Sequence[str] = ("model",),
    score: str = "p",
    label: str = "label",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(keys…, metric, threshold, score): best over all distinct scores and 1.0, lowest threshold on a tie.

    Precision and recall at the added 1.0 are those of the curve's end point
    (1 and 0); an unknown metric falls back to f1. All metrics share the counts.
    """
    wanted = [metrics] if isinstance(metrics, str) else list(metrics)
    names = list(dict.fromkeys(m if m in THRESHOLD_METRICS else "f1" for m in wanted))
    steps = running_counts(scored, keys, score, label, rows_per_range)

    def confusion(tp: str, fp: str) -> list[str]:
        return [f"n_neg - {fp}", fp, f"n_pos - {tp}", tp]

    def candidate(value, threshold, extra):
        return F.struct((-value).alias("minus"), threshold.alias("threshold"), F.lit(extra).alias("extra"))

    every = rate_texts(confusion("tp", "fp"))
    every["recall"] = f"CASE WHEN n_pos = 0 THEN 1.0D ELSE {every['recall']} END"
    plain = {n: candidate(F.expr(every[n]), F.col("score"), 0) for n in names}
    # p >= 1.0: the counts of the highest score if it reaches 1.0, else nothing.
    extra = rate_texts(confusion("if(score >= 1.0D, tp, 0)", "if(score >= 1.0D, fp, 0)"))
    extra.update({"precision": "1.0D", "recall": "0.0D"})
    # Without unpivoting first, the order of the running counts serves the
    # aggregation as it is: no further sort.
    best = steps.groupBy(*keys).agg(*[
        F.least(
            F.min(plain[n]),
            F.min(F.when(F.col("is_first"), candidate(F.expr(extra[n]), F.lit(1.0), 1))),
        ).alias(n)
        for n in names
    ])
    return best.unpivot(list(keys), names, "metric", "best").select(
        *keys, "metric", "best.threshold", (-F.col("best.minus")).alias("score")
    )


def matrices_at(
    scored: DataFrame,
    thresholds: Sequence[float] = tuple(MATRIX_THRESHOLDS),
    keys: Sequence[str] = ("model",),
) -> DataFrame:
    """The four counts and accuracy, precision, recall, f1 at a few thresholds."""
    sweep = threshold_sweep(scored, keys, thresholds)
    return with_rates(
        sweep.select(*keys, "threshold", *CONFUSION), ["accuracy", "precision", "recall", "f1"]
    )


def sweep_long(sweep: DataFrame, keys: Sequence[str] = ("model",), metrics: Sequence[str] = tuple(THRESHOLD_METRICS)) -> DataFrame:
    """(keys…, threshold, metric, value) for the metrics that the sweep has."""
    present = [m for m in metrics if m in sweep.columns]
    return sweep.unpivot([*keys, "threshold"], present, "metric", "value")


def with_optimal_predictions(scored: DataFrame, best: DataFrame, metric: str = "f1") -> DataFrame:
    """Rows of ``{model}_optimal``: the same score, predicted at the model's own best threshold.

    ``best`` has one row per model and metric; its size is checked before it is
    broadcast, so the scored rows are not shuffled.
    """
    cut = best.where(F.col("metric") == metric).select("model", F.col("threshold").alias("cut"))
    return (
        scored.join(broadcast_if_small(cut), "model")
        .withColumns({
            "prediction": predict_at(F.col("p"), F.col("cut")),
            "model": F.concat("model", F.lit("_optimal")),
        })
        .select(*scored.columns)
    )


def prediction_table(
    scored: DataFrame,
    models: Sequence[str],
    id_column: str = "customerID",
    without_probability: Sequence[str] = (),
) -> DataFrame:
    """One row per customer: CustomerID, True_Churn, {model}_prediction, {model}_probability.

    The model list is fixed, so no pass is spent on finding it.
    """
    aggregates = []
    for m in models:
        here = F.col("model") == m
        aggregates.append(F.max(F.when(here, F.col("prediction"))).alias(f"{m}_prediction"))
        if m not in without_probability:
            aggregates.append(F.max(F.when(here, F.col("p"))).alias(f"{m}_probability"))
    return scored.groupBy(
        F.col(id_column).alias("CustomerID"), F.col("label").alias("True_Churn")
    ).agg(*aggregates)
