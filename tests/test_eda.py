import math

import pytest
from pyspark.sql import functions as F

from retention.operators import eda


def test_target_with_missing_values(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("No",), (None,)], "Churn string")
    assert [tuple(r) for r in eda.target_distribution(df).collect()] == [("No", 2, 50.0), ("Yes", 1, 25.0)]
    assert eda.resolve_target(df.withColumnRenamed("Churn", "Label")) == "Label"
    with pytest.raises(ValueError):
        eda.resolve_target(spark.range(1))


def test_crosstab_fills_zero(spark):
    df = spark.createDataFrame([("a", "Yes"), ("a", "Yes"), ("b", "No"), (None, "No")], "x string, Churn string")
    got = {(r.value, r.target): (r["count"], r.percentage) for r in eda.category_by_target(df, ["x", "absent"]).collect()}
    assert got == {("a", "Yes"): (2, 100.0), ("a", "No"): (0, 0.0), ("b", "Yes"): (0, 0.0), ("b", "No"): (1, 100.0)}


@pytest.mark.parametrize("small_group", [1000, 3])
def test_box(spark, small_group):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0]
    df = spark.createDataFrame([(v, "Yes") for v in values] + [(7.0, "No")], "tenure double, Churn string")
    got = {r.target: r for r in eda.box_statistics(df, ["tenure"], small_group=small_group).collect()}
    yes = got["Yes"]
    assert (yes.n, yes.q1, yes.median, yes.q3) == (6, 2.25, 3.5, 4.75)
    assert (yes.low_whisker, yes.high_whisker, yes.n_outliers) == (1.0, 5.0, 1)
    assert (got["No"].low_whisker, got["No"].high_whisker) == (7.0, 7.0)
    out = eda.box_outliers(df, ["tenure"], small_group=small_group).collect()
    assert [(r.target, r.value, r["count"]) for r in out] == [("Yes", 100.0, 1)]


def test_density_is_exact_and_sums_to_one(spark):
    values = [1.0, 1.0, 2.0, 4.0, 9.0]
    df = spark.createDataFrame([(v, "Yes") for v in values] + [(3.0, "No")], "tenure double, Churn string")
    rows = eda.density(df, ["tenure"]).orderBy("i").collect()
    assert [(r.x, r.density) for r in rows if r.target == "No"] == [(3.0, 1.0)]
    curve = [r for r in rows if r.target == "Yes"]
    mean = sum(values) / 5
    h = math.sqrt(sum((v - mean) ** 2 for v in values) / 4) * 5 ** -0.2
    assert len(curve) == 100 and curve[0].x == pytest.approx(1 - 2 * h) and curve[-1].x == pytest.approx(9 + 2 * h)
    for r in curve:
        want = sum(math.exp(-0.5 * ((r.x - v) / h) ** 2) for v in values) / (5 * h * math.sqrt(2 * math.pi))
        assert r.density == pytest.approx(want, rel=1e-12)
    assert sum(r.density for r in curve) * (curve[1].x - curve[0].x) == pytest.approx(1, abs=0.05)


def corr_table(spark):
    return spark.createDataFrame(
        [(1, "b", 1.0, 7.0, 2.0), (2, "a", None, 7.0, 1.0), (3, "b", 3.0, 7.0, 9.0), (4, None, 5.0, 7.0, None), (5, "c", 4.0, 7.0, 3.0)],
        "customerID long, t string, x double, k double, y double",
    )


def pearson(pairs):
    n = len(pairs)
    ma, mb = sum(a for a, _ in pairs) / n, sum(b for _, b in pairs) / n
    cov = sum((a - ma) * (b - mb) for a, b in pairs)
    return cov / math.sqrt(sum((a - ma) ** 2 for a, _ in pairs) * sum((b - mb) ** 2 for _, b in pairs))


@pytest.mark.parametrize("few", [500, 0])
def test_correlation(spark, monkeypatch, few):
    """few=0 sends the text column over the join for columns with many values."""
    monkeypatch.setattr(eda, "FEW_VALUES", few)
    got = {(r.a, r.b): r.r for r in eda.correlation_matrix(corr_table(spark)).collect()}
    codes = {1: 0, 2: 1, 3: 0, 4: -1, 5: 2}
    x = {1: 1.0, 3: 3.0, 4: 5.0, 5: 4.0}
    y = {1: 2.0, 2: 1.0, 3: 9.0, 5: 3.0}
    assert len(got) == 10
    assert got["t", "customerID"] == pytest.approx(pearson([(i, codes[i]) for i in range(1, 6)]))
    assert got["x", "t"] == pytest.approx(pearson([(x[i], codes[i]) for i in x]))
    assert got["y", "x"] == pytest.approx(pearson([(x[i], y[i]) for i in (1, 3, 5)]))
    assert got["k", "x"] is None and got["y", "k"] is None and got["k", "customerID"] is None


def test_correlation_with_text_id(spark):
    df = corr_table(spark).withColumn("customerID", F.concat(F.lit("c"), F.col("customerID")))
    got = {(r.a, r.b): r.r for r in eda.correlation_matrix(df).collect()}
    assert got["t", "customerID"] == pytest.approx(pearson(list(zip(range(5), [0, 1, 0, -1, 2]))))


def test_histogram(spark):
    df = spark.createDataFrame([(0, "No"), (12, "Yes"), (11, "No"), (6, "No"), (None, "No")], "tenure int, Churn string")
    got = {(r.bin, r.target): r["count"] for r in eda.tenure_histogram(df).collect()}
    assert len(got) == 24 and sum(got.values()) == 4
    assert got[0, "No"] == 1 and got[11, "Yes"] == 1 and got[11, "No"] == 1 and got[6, "No"] == 1
    flat = eda.tenure_histogram(spark.createDataFrame([(5, "No")], "tenure int, Churn string")).collect()
    assert sum(r["count"] for r in flat) == 1 and flat[0].low == 4.5


def test_churn_by_tenure_lists_all_groups(spark):
    df = spark.createDataFrame([(12, "Yes"), (1, "No"), (0, "Yes"), (70, "No")], "tenure int, Churn string")
    rows = eda.churn_by_tenure(df).orderBy("position").collect()
    assert [(r.tenure_group, r.churn_rate) for r in rows] == [
        ("0-12", 50.0), ("13-24", 0.0), ("25-36", 0.0), ("37-48", 0.0), ("49-60", 0.0), ("61-72", 0.0)]


def test_churn_by_service(spark):
    df = spark.createDataFrame(
        [("Yes", "No", "Yes"), (None, "No", "Yes"), ("No", "DSL", "No")], "a string, b string, Churn string"
    )
    wide = eda.churn_by_service(df, ["a", "b", "absent"])
    assert [tuple(r) for r in wide.collect()] == [("a", 100.0, 50.0)]
    assert {(r.Status, r["Churn Rate (%)"]) for r in eda.service_long(wide).collect()} == {
        ("With Service", 100.0), ("Without Service", 50.0)}
