"""ROC and precision-recall curves, AUC and average precision per key.

All of them need running counts over the scores in descending order. The rows
are first aggregated to one per (keys, score), so ties and score piles collapse
before the shuffle. Few distinct scores are then summed in one window per key.
Many are cut into ranges at the quantiles of the pooled scores: no (key, range)
group then holds more than its share of the pool, whatever the score
distribution, and totals per range are added on as offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import stage

ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 10_000


def score_counts(scored: DataFrame, keys: Sequence[str], score: str = "p", label: str = "label") -> DataFrame:
    """(keys…, score, pos, neg) with one row per distinct score; rows without a score are left out."""
    positive = F.col(label) == 1
    # x + 0.0 turns -0.0 into 0.0, so both are one score.
    return (
        scored.where(F.col(score).isNotNull() & ~F.isnan(score))
        .groupBy(*keys, (F.col(score) + F.lit(0.0)).alias("score"))
        .agg(
            F.count(F.when(positive, 1)).alias("pos"),
            F.count(F.when(~positive, 1)).alias("neg"),
        )
    )


def score_ranges(
    scored: DataFrame, score: str = "p", rows_per_range: int = ROWS_PER_RANGE
) -> list[float]:
    """Inner range bounds from a quantile sketch of the pooled scores; none while rows are few."""
    n = scored.count()
    ranges = min(-(-n // rows_per_range), MAX_RANGES)
    if ranges <= 1:
        return []
    probabilities = [j / ranges for j in range(1, ranges)]
    bounds = scored.where(~F.isnan(score)).agg(
        F.percentile_approx(score, probabilities, 2 * MAX_RANGES)
    ).first()[0]
    return sorted(set(bounds or []))


def running_counts(
    scored: DataFrame,
    keys: Sequence[str],
    score: str = "p",
    label: str = "label",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(keys…, score, pos, neg, tp, fp, n_pos, n_neg, next_pos, next_neg, is_first).

    ``tp``/``fp`` count the rows with at least this score. ``next_*`` are the
    counts of the next lower score, null at the lowest one.
    """
    keys = list(keys)
    counts = score_counts(scored, keys, score, label)
    bounds = score_ranges(scored.select(score), score, rows_per_range)
    if not bounds:
        down = Window.partitionBy(*keys).orderBy(F.desc("score"))
        whole = Window.partitionBy(*keys)
        return counts.select(
            "*",
            F.sum("pos").over(down).alias("tp"),
            F.sum("neg").over(down).alias("fp"),
            F.sum("pos").over(whole).alias("n_pos"),
            F.sum("neg").over(whole).alias("n_neg"),
            F.lead("pos").over(down).alias("next_pos"),
            F.lead("neg").over(down).alias("next_neg"),
            (F.row_number().over(down) == 1).alias("is_first"),
        )

    splits = [float("-inf"), *bounds, float("inf")]
    # Written once: the totals and the curve both read it, and the distinct scores are shuffled only once for the two.
    ranged = stage(Bucketizer(splits=splits, inputCol="score", outputCol="range").transform(counts), "score-counts")
    totals = ranged.groupBy(*keys, "range").agg(
        F.sum("pos").alias("range_pos"),
        F.sum("neg").alias("range_neg"),
        F.max_by(F.struct("pos", "neg"), "score").alias("top"),
    )
    # One row per key and range: at most 10,000 per key.
    down = Window.partitionBy(*keys).orderBy(F.desc("range"))
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        "range",
        (F.sum("range_pos").over(down) - F.col("range_pos")).alias("pos_before"),
        (F.sum("range_neg").over(down) - F.col("range_neg")).alias("neg_before"),
        F.sum("range_pos").over(whole).alias("n_pos"),
        F.sum("range_neg").over(whole).alias("n_neg"),
        F.lead("top").over(down).alias("following"),
        (F.row_number().over(down) == 1).alias("top_range"),
    )
    within = Window.partitionBy(*keys, "range").orderBy(F.desc("score"))
    return ranged.join(offsets, [*keys, "range"]).select(
        *keys,
        "score",
        "pos",
        "neg",
        (F.sum("pos").over(within) + F.col("pos_before")).alias("tp"),
        (F.sum("neg").over(within) + F.col("neg_before")).alias("fp"),
        "n_pos",
        "n_neg",
        F.coalesce(F.lead("pos").over(within), F.col("following.pos")).alias("next_pos"),
        F.coalesce(F.lead("neg").over(within), F.col("following.neg")).alias("next_neg"),
        ((F.row_number().over(within) == 1) & F.col("top_range")).alias("is_first"),
    )


def ranking_metrics(
    scored: DataFrame,
    keys: Sequence[str],
    score: str = "p",
    label: str = "label",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(keys…, auc, average_precision).

    AUC counts a tie as one half and is null when a key has one class only.
    Average precision is the step sum; 0 without positives.
    """
    steps = running_counts(scored, keys, score, label, rows_per_range)
    double = lambda name: F.col(name).cast("double")
    pairs = F.sum(double("neg") * (double("tp") - double("pos") / 2.0))
    n_pos, n_neg = F.max(double("n_pos")), F.max(double("n_neg"))
    step = double("pos") / F.nullif(double("n_pos"), F.lit(0.0)) * double("tp") / (double("tp") + double("fp"))
    return steps.groupBy(*keys).agg(
        F.when((n_pos > 0) & (n_neg > 0), F.try_divide(pairs, n_pos * n_neg)).alias("auc"),
        F.coalesce(F.sum(step), F.lit(0.0)).alias("average_precision"),
    )


def roc_curve(
    scored: DataFrame,
    keys: Sequence[str],
    score: str = "p",
    label: str = "label",
    drop_intermediate: bool = True,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(keys…, fpr, tpr, threshold) from (0, 0) on, thresholds descending.

    With ``drop_intermediate`` a point between two equal steps is left out. The
    start point has the highest score plus 1 as its threshold.
    """
    steps = running_counts(scored, keys, score, label, rows_per_range)
    if drop_intermediate:
        steps = steps.where(
            F.col("is_first")
            | F.col("next_pos").isNull()
            | (F.col("next_pos") != F.col("pos"))
            | (F.col("next_neg") != F.col("neg"))
        )
    fpr = F.try_divide(F.col("fp").cast("double"), F.col("n_neg").cast("double"))
    tpr = F.try_divide(F.col("tp").cast("double"), F.col("n_pos").cast("double"))
    point = F.struct(fpr.alias("fpr"), tpr.alias("tpr"), F.col("score").alias("threshold"))
    start = F.struct(
        F.when(F.col("n_neg") > 0, 0.0).alias("fpr"),
        F.when(F.col("n_pos") > 0, 0.0).alias("tpr"),
        (F.col("score") + 1.0).alias("threshold"),
    )
    points = F.explode(F.when(F.col("is_first"), F.array(start, point)).otherwise(F.array(point)))
    return steps.select(*keys, points.alias("pt")).select(*keys, "pt.*")


def pr_curve(
    scored: DataFrame,
    keys: Sequence[str],
    score: str = "p",
    label: str = "label",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(keys…, precision, recall, threshold) at every distinct score, and the end point (1, 0)
    without a threshold. Recall is 1 throughout when there are no positives."""
    steps = running_counts(scored, keys, score, label, rows_per_range)
    precision = F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))
    recall = F.coalesce(F.try_divide(F.col("tp").cast("double"), F.col("n_pos").cast("double")), F.lit(1.0))
    point = F.struct(precision.alias("precision"), recall.alias("recall"), F.col("score").alias("threshold"))
    end = F.struct(
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"),
    )
    points = F.explode(F.when(F.col("is_first"), F.array(point, end)).otherwise(F.array(point)))
    return steps.select(*keys, points.alias("pt")).select(*keys, "pt.*")


def pr_summary(
    scored: DataFrame,
    keys: Sequence[str],
    score: str = "p",
    label: str = "label",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(keys…, pr_auc, baseline): trapezoid area of the curve, and the positive share.

    The neighbour of a point follows from its own counts: the next higher score
    has tp - pos and fp - neg, and the highest score meets the end point (1, 0).
    """
    steps = running_counts(scored, keys, score, label, rows_per_range)
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    prev_tp, prev_fp = tp - F.col("pos"), fp - F.col("neg")
    precision = tp / (tp + fp)
    prev_precision = F.when(F.col("is_first"), F.lit(1.0)).otherwise(
        F.try_divide(prev_tp, prev_tp + prev_fp)
    )
    width = F.coalesce(
        F.try_divide(F.col("pos").cast("double"), F.col("n_pos").cast("double")),
        F.when(F.col("is_first"), 1.0).otherwise(0.0),
    )
    positives, rows = F.max("n_pos").cast("double"), (F.max("n_pos") + F.max("n_neg")).cast("double")
    return steps.groupBy(*keys).agg(
        F.sum(width * (precision + prev_precision) / 2.0).alias("pr_auc"),
        F.try_divide(positives, rows).alias("baseline"),
    )
