import itertools
import random

import pytest
from pyspark.sql import functions as F

from retention.config import THRESHOLDS
from retention.operators import curves as cu
from retention.operators import cv
from retention.operators import metrics as me
from retention.operators import thresholds as th

SCHEMA = "customerID long, model string, label int, p double, prediction int"


def table(spark, rows):
    """rows: (model, label, p)."""
    return spark.createDataFrame(
        [(i, m, y, p, int(p >= 0.5) if p is not None else 1) for i, (m, y, p) in enumerate(rows)], SCHEMA
    )


def random_rows(n=600, seed=5):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        y = int(rnd.random() < 0.3)
        rows.append(("a", y, rnd.choice([rnd.random(), 0.5, 0.35, 0.011])))
        rows.append(("b", y, min(1.0, round(rnd.random() * 0.02 + 0.01 * y, 3))))
    return rows


def brute_auc(pairs):
    pos = [p for y, p in pairs if y == 1]
    neg = [p for y, p in pairs if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a, b in itertools.product(pos, neg)) / (len(pos) * len(neg))


def brute_points(pairs):
    """(score, tp, fp) at each distinct score, descending."""
    return [
        (t, sum(y for y, p in pairs if p >= t), sum(1 - y for y, p in pairs if p >= t))
        for t in sorted({p for _, p in pairs}, reverse=True)
    ]


def brute_ap(pairs):
    n_pos = sum(y for y, _ in pairs)
    total, before = 0.0, 0
    for _, tp, fp in brute_points(pairs):
        total += (tp - before) / n_pos * tp / (tp + fp)
        before = tp
    return total


@pytest.mark.parametrize("rows_per_range", [10**9, 100, 7])
def test_ranking_metrics_against_brute_force(spark, rows_per_range):
    rows = random_rows()
    got = {r.model: r for r in cu.ranking_metrics(table(spark, rows), ["model"], rows_per_range=rows_per_range).collect()}
    for m in "ab":
        pairs = [(y, p) for k, y, p in rows if k == m]
        assert got[m].auc == pytest.approx(brute_auc(pairs), abs=1e-12)
        assert got[m].average_precision == pytest.approx(brute_ap(pairs), abs=1e-12)


@pytest.mark.parametrize("rows_per_range", [10**9, 100])
def test_curves_against_brute_force(spark, rows_per_range):
    rows = random_rows(200)
    df = table(spark, rows)
    for m in "ab":
        pairs = [(y, p) for k, y, p in rows if k == m]
        points = brute_points(pairs)
        n_pos, n_neg = sum(y for y, _ in pairs), sum(1 - y for y, _ in pairs)
        kept = [
            pt for i, pt in enumerate(points)
            if i in (0, len(points) - 1)
            or (points[i + 1][1] - 2 * pt[1] + points[i - 1][1], points[i + 1][2] - 2 * pt[2] + points[i - 1][2]) != (0, 0)
        ]
        want = [(0.0, 0.0, points[0][0] + 1)] + [(fp / n_neg, tp / n_pos, t) for t, tp, fp in kept]
        got = cu.roc_curve(df.where(F.col("model") == m), ["model"], rows_per_range=rows_per_range)
        assert [(r.fpr, r.tpr, r.threshold) for r in got.orderBy(F.desc("threshold")).collect()] == want
        full = cu.roc_curve(df.where(F.col("model") == m), ["model"], drop_intermediate=False, rows_per_range=rows_per_range)
        assert full.count() == len(points) + 1
        pr = cu.pr_curve(df.where(F.col("model") == m), ["model"], rows_per_range=rows_per_range)
        got_pr = [(r.precision, r.recall, r.threshold) for r in pr.orderBy(F.col("threshold").asc_nulls_last()).collect()]
        want_pr = [(tp / (tp + fp), tp / n_pos, t) for t, tp, fp in reversed(points)] + [(1.0, 0.0, None)]
        assert got_pr == want_pr
        area = sum((a[1] - b[1]) * (a[0] + b[0]) / 2 for a, b in zip(want_pr, want_pr[1:]))
        summary = cu.pr_summary(df.where(F.col("model") == m), ["model"], rows_per_range=rows_per_range).first()
        assert summary.pr_auc == pytest.approx(area, abs=1e-12)
        assert summary.baseline == pytest.approx(n_pos / len(pairs))


def test_one_class_and_equal_scores(spark):
    df = table(spark, [("only_neg", 0, 0.1), ("only_neg", 0, 0.9), ("only_pos", 1, 0.4), ("flat", 1, 0.5), ("flat", 0, 0.5)])
    got = {r.model: r for r in me.full_metrics(df).collect()}
    assert got["only_neg"].auc is None and got["only_neg"].average_precision == 0.0
    assert got["only_pos"].auc is None and got["only_pos"].average_precision == 1.0
    assert got["flat"].auc == 0.5 and got["flat"].average_precision == 0.5
    assert (got["only_pos"].precision, got["only_pos"].recall, got["only_pos"].f1) == (0.0, 0.0, 0.0)
    assert [r.recall for r in cu.pr_curve(df.where("model = 'only_neg'"), ["model"]).orderBy("threshold").collect()] == [0.0, 1.0, 1.0]
    assert me.full_metrics(df.limit(0)).count() == 0


def test_monotone_maps_keep_auc(spark):
    df = table(spark, random_rows(200))
    squashed = df.withColumn("p", F.col("p") * F.col("p") / 2)
    a = {r.model: r.auc for r in cu.ranking_metrics(df, ["model"]).collect()}
    b = {r.model: r.auc for r in cu.ranking_metrics(squashed, ["model"]).collect()}
    assert a == pytest.approx(b)


def test_model_without_scores(spark):
    df = table(spark, [("hard", 1, None), ("hard", 0, None), ("soft", 1, 0.7), ("soft", 0, 0.2)])
    got = {r.model: r for r in me.model_metrics(df).collect()}
    assert got["hard"].auc is None and got["hard"].recall == 1.0 and got["soft"].auc == 1.0
    shown = {r.Model: r for r in me.comparison_table(me.model_metrics(df)).collect()}
    assert shown["hard"].Auc == 0.0
    assert "Auc" not in {r.Metric for r in me.comparison_long(me.model_metrics(df)).where("Model = 'hard'").collect()}
    assert [r.model for r in th.threshold_sweep(df).select("model").distinct().collect()] == ["soft"]


def test_segments(spark):
    df = table(spark, random_rows(50)).withColumn(
        "segment_col", F.when(F.col("customerID") % 5 == 0, None).when(F.col("customerID") % 2 == 0, "x").otherwise("y")
    )
    got = me.segment_metrics(df, "segment_col", names={"x": "even"})
    assert {r.segment for r in got.collect()} == {"even", "y"}
    assert sum(r["count"] for r in got.collect()) == 80
    assert {r.segment for r in me.segment_metrics(df, "segment_col", baseline="x").collect()} == {"y"}
    assert me.segment_metrics(df, "absent").count() == 0


def test_sweep_against_brute_force(spark):
    rows = random_rows(300) + [("a", 1, k / 100) for k in range(1, 100)]
    got = {(r.model, r.threshold): r for r in th.threshold_sweep(table(spark, rows)).collect()}
    assert len(got) == 198
    for m in "ab":
        pairs = [(y, p) for k, y, p in rows if k == m]
        last = 2.0
        for t in THRESHOLDS:
            tp = sum(1 for y, p in pairs if y == 1 and p >= t)
            fp = sum(1 for y, p in pairs if y == 0 and p >= t)
            r = got[m, t]
            assert (r.true_positives, r.false_positives) == (tp, fp)
            assert r.true_positives + r.false_positives + r.true_negatives + r.false_negatives == len(pairs)
            assert r.recall <= last
            last = r.recall


def test_best_thresholds(spark):
    rows = random_rows(300)
    df = table(spark, rows)
    sweep = th.threshold_sweep(df).collect()
    for r in th.optimal_thresholds(df).collect():
        values = [(-s[r.metric], s.threshold) for s in sweep if s.model == r.model]
        assert (-r.score, r.threshold) == min(values)
    with pytest.raises(ValueError):
        th.best_on_grid(th.threshold_sweep(df), metrics=["auc"])


@pytest.mark.parametrize("rows_per_range", [10**9, 50])
def test_best_over_all_scores(spark, rows_per_range):
    rows = random_rows(150) + [("b", 1, 1.0)]
    df = table(spark, rows)

    def f1(tp, fp, fn):
        return 2 * tp / (2 * tp + fp + fn) if tp else 0.0

    got = {(r.model, r.metric): r for r in th.best_over_scores(
        df, ["f1", "precision", "recall", "balanced_accuracy"], rows_per_range=rows_per_range).collect()}
    for m in "ab":
        pairs = [(y, p) for k, y, p in rows if k == m]
        n_pos = sum(y for y, _ in pairs)
        values = {"f1": [], "precision": [], "recall": []}
        for t, tp, fp in reversed(brute_points(pairs)):
            values["f1"].append((f1(tp, fp, n_pos - tp), t))
            values["precision"].append((tp / (tp + fp), t))
            values["recall"].append((tp / n_pos, t))
        tp = sum(1 for y, p in pairs if y == 1 and p >= 1.0)
        fp = sum(1 for y, p in pairs if y == 0 and p >= 1.0)
        values["f1"].append((f1(tp, fp, n_pos - tp), 1.0))
        values["precision"].append((1.0, 1.0))
        values["recall"].append((0.0, 1.0))
        for metric, options in values.items():
            best = max(v for v, _ in options)
            first = min(t for v, t in options if v == best)
            assert got[m, metric].score == pytest.approx(best)
            assert got[m, metric].threshold == first
    unknown = th.best_over_scores(df, "nonsense").collect()
    assert {r.metric for r in unknown} == {"f1"}


def test_classification_report(spark):
    df = table(spark, [("m", 1, 0.9), ("m", 1, 0.1), ("m", 0, 0.8), ("m", 0, 0.2), ("m", 0, 0.3)])
    got = {r.row: r for r in me.classification_report(df).collect()}
    assert got["Churn"].support == 2 and got["Not Churn"].support == 3
    assert got["Churn"].f1 == pytest.approx(0.5) and got["Not Churn"].f1 == pytest.approx(2 / 3)
    assert got["accuracy"].precision == pytest.approx(0.6)
    assert got["macro avg"].f1 == pytest.approx((0.5 + 2 / 3) / 2)
    assert got["weighted avg"].recall == pytest.approx(0.6)


def test_prediction_table_and_optimal_rows(spark):
    rows = [(1, "a", 1, 0.31, 0), (1, "hard", 1, None, 1), (2, "a", 0, 0.2, 0), (2, "hard", 0, None, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    best = th.optimal_thresholds(df)
    optimal = th.with_optimal_predictions(df, best)
    assert {(r.customerID, r.model, r.prediction) for r in optimal.collect()} == {(1, "a_optimal", 1), (2, "a_optimal", 0)}
    out = th.prediction_table(df.unionByName(optimal), ["a", "hard", "a_optimal"], without_probability=["hard"])
    assert out.columns == [
        "CustomerID", "True_Churn", "a_prediction", "a_probability", "hard_prediction",
        "a_optimal_prediction", "a_optimal_probability",
    ]
    assert out.where("CustomerID = 1").first()["hard_prediction"] == 1


def test_cv_summary_uses_population_deviation(spark):
    df = spark.createDataFrame([("m", 0, 0.5), ("m", 1, 0.7)], "model string, fold int, accuracy double")
    row = cv.cv_summary(df).first()
    assert (row.Mean, row.Std) == (pytest.approx(0.6), pytest.approx(0.1))


def test_named_scoring(spark):
    df = table(spark, random_rows(50)).withColumn("fold", (F.col("customerID") % 2).cast("int"))
    assert cv.fold_metrics(df, scoring="roc_auc").columns == ["model", "fold", "roc_auc"]
    assert cv.fold_metrics(df, scoring=["f1", "specificity"]).columns == ["model", "fold", "f1", "specificity"]
    with pytest.raises(ValueError):
        cv.fold_metrics(df, scoring="gain")


def test_a_third_of_all_rows_in_one_segment_and_score(spark):
    """Ranges are cut by the pooled scores; the hot score collapses to one row and nothing is lost."""
    rnd = random.Random(1)
    rows = [("hot", int(rnd.random() < 0.4), 0.123456) for _ in range(700)]
    rows += [(rnd.choice("abc"), int(rnd.random() < 0.4), rnd.random()) for _ in range(1400)]
    got = {r.model: r for r in cu.ranking_metrics(table(spark, rows), ["model"], rows_per_range=60).collect()}
    assert got["hot"].auc == 0.5
    for m in "abc":
        pairs = [(y, p) for k, y, p in rows if k == m]
        assert got[m].auc == pytest.approx(brute_auc(pairs), abs=1e-12)
        assert got[m].average_precision == pytest.approx(brute_ap(pairs), abs=1e-12)
    totals = cu.running_counts(table(spark, rows), ["model"], rows_per_range=60).agg(F.sum("pos"), F.sum("neg")).first()
    assert totals[0] + totals[1] == 2100
