"""Inputs that real tables hold: rare classes, constant columns, quoted text, other targets, missing keys."""

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from retention.operators import boosting, eda, inspect_models, metrics, prep, train
from retention.sources import staging, tables


@pytest.fixture(scope="module")
def two_shares(spark):
    """5 % of class 1 on one side of a cut, 25 % on the other: one majority, two shares."""
    rows = [(i, float(i >= 400), int(i % 20 == 0 if i < 400 else i % 4 == 0)) for i in range(800)]
    table = spark.createDataFrame(rows, "customerID long, x double, Churn_Binary int")
    return table.select("customerID", "Churn_Binary", array_to_vector(F.array("x")).alias("features")).cache()


def shares(df):
    return {round(r[0], 9) for r in df.select(vector_to_array("probability")[1]).distinct().collect()}


def test_leaves_keep_their_shares(spark, two_shares):
    tree = train.create_model("dt", {"max_depth": 3}).fit(two_shares)
    assert shares(tree.transform(two_shares)) == {0.05, 0.25}
    nodes = inspect_models.tree_nodes(spark, tree, ["x"]).collect()
    assert len(nodes) == 3
    assert {round(n["impurity"], 9) for n in nodes} == {round(2 * p * (1 - p), 9) for p in (0.05, 0.25, 0.15)}
    assert [tuple(r) for r in inspect_models.tree_importance(spark, tree, ["x"]).collect()] == [("x", 1.0)]
    forest = train.create_model("rf", {"n_estimators": 10, "max_depth": 1}).fit(two_shares)
    low, high = sorted(shares(forest.transform(two_shares)))
    assert low < 0.12 < 0.18 < high


def test_first_boosting_round_splits(two_shares):
    assert len(shares(boosting.train_boosted(two_shares, rounds=1).transform(two_shares))) == 2


def test_votes_of_share_models(two_shares):
    base = {"dt": train.create_model("dt", {"max_depth": 3}), "rf": train.create_model("rf", {"n_estimators": 3, "max_depth": 2})}
    vote = train.train_voting(two_shares, base, "soft")
    out = vote.transform(two_shares)
    assert set(out.columns) == {*two_shares.columns, "probability", "prediction"}
    assert len(shares(out)) == 2


@pytest.mark.parametrize("kind, params", [("lr", {"penalty": "l3"}), ("lr", {"c": 1}), ("dt", {"depth": 3}), ("rf", {"trees": 3})])
def test_unknown_parameters_are_refused(kind, params):
    with pytest.raises(ValueError):
        train.create_model(kind, params)


def test_class_weight_map(two_shares):
    doubled = train.create_model("dt", {"max_depth": 3, "class_weight": {0: 1, 1: 3}}).fit(two_shares)
    assert shares(doubled.transform(two_shares)) == {round(3 * p / (3 * p + 1 - p), 9) for p in (0.05, 0.25)}


def test_constant_column_with_missing_values(spark):
    table = spark.createDataFrame([(0.1 if i % 10 else None, "a") for i in range(1000)], "x double, c string")
    model = prep.Preprocessor(numerical=["x"], categorical=["c"]).fit(table)
    assert {r["x"] for r in model.encode(table).collect()} == {0.0}


def test_quoted_csv(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "a.csv").write_text('customerID,note\n1,"a ""b"", c"\n2,"line one\nline two"\n3,plain\n')
    rows = {r["customerID"]: r["note"] for r in tables.read_raw(spark, str(folder), multi_line=True).collect()}
    assert rows == {"1": 'a "b", c', "2": "line one\nline two", "3": "plain"}


def test_csv_split_keeps_types(spark, tmp_path):
    table = spark.createDataFrame([(1, 0.5, 'say "x", y', "train"), (2, None, None, "test")], "a int, b double, c string, split string")
    tables.write_split(table, str(tmp_path / "s"), "csv")
    back = tables.read_split(spark, str(tmp_path / "s"), file_format="csv", schema="a int, b double, c string")
    assert dict(back.dtypes)["a"] == "int" and sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))


def test_targets_of_other_types(spark):
    rows = [(i % 72 + 1, "Yes" if i % 2 else "No", i % 3 == 0) for i in range(600)]
    table = spark.createDataFrame(rows, "tenure int, PhoneService string, flag boolean")
    forms = {
        "text": F.when(F.col("flag"), "Yes").otherwise("No"),
        "number": F.col("flag").cast("int"),
        "flag": F.col("flag"),
    }
    tenure, service = [], []
    for form in forms.values():
        df = table.withColumn("Churn_Binary", form)
        tenure.append(sorted(map(tuple, eda.churn_by_tenure(df, target="Churn_Binary").collect())))
        service.append(sorted(map(tuple, eda.churn_by_service(df, ["PhoneService"], "Churn_Binary").collect())))
    assert tenure[0] == tenure[1] == tenure[2] and service[0] == service[1] == service[2]
    assert service[0][0][1] > 0


def test_missing_keys_keep_their_auc(spark):
    rows = [(None if i % 2 else "m", i % 3 == 0, i / 60, int(i > 30)) for i in range(60)]
    scored = spark.createDataFrame(rows, "model string, y boolean, p double, prediction int").withColumn("label", F.col("y").cast("int"))
    assert all(r["auc"] is not None for r in metrics.full_metrics(scored).collect())


def test_correlation_jobs_do_not_grow_with_missing_values(spark):
    columns = [f"c{i}" for i in range(10)]
    rows = [tuple([i, *[float((i * (k + 3)) % 17) if (i + k) % 7 else None for k in range(10)]]) for i in range(150)]
    table = spark.createDataFrame(rows, "customerID long, " + ", ".join(f"{c} double" for c in columns))
    tracker, group = spark.sparkContext.statusTracker(), "correlation"
    spark.sparkContext.setJobGroup(group, group)
    got = {(r["a"], r["b"]): r["r"] for r in eda.correlation_matrix(table).collect()}
    assert len(tracker.getJobIdsForGroup(group)) <= 10
    spark.sparkContext.setJobGroup("", "")
    frame = table.toPandas()[["customerID", *columns]].corr()
    assert all(r == pytest.approx(frame.loc[a, b]) for (a, b), r in got.items())


def test_a_dot_in_a_category(spark):
    table = spark.createDataFrame([(1, "a.b"), (2, "c"), (3, "a`d")], "customerID long, c string")
    model = prep.Preprocessor(numerical=[], categorical=["c"]).fit(table)
    assert model.encode(table, ["customerID"]).count() == 3


def test_local_session_without_a_folder(spark, monkeypatch):
    conf = {"spark.checkpoint.dir": None}
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *d: conf.get(key, *d))
    assert staging.shared_folder(spark) == staging.shared_folder(spark)


@pytest.mark.parametrize("n0, n1, want", [(5, 5, 3), (15, 15, 9), (7, 3, 3), (1, 1, 1), (10, 0, 3)])
def test_split_has_the_size_of_its_share(spark, n0, n1, want):
    from retention.operators import sampling

    rows = [(i, int(i >= n0)) for i in range(n0 + n1)]
    split = sampling.stratified_split(spark.createDataFrame(rows, "customerID long, Churn_Binary int"), 0.3)
    assert split.where("split = 'test'").count() == want


def test_quantiles_of_many_groups_and_of_large_ones_together(spark):
    from retention.operators import order_stats

    rows = spark.range(60_000).selectExpr("CAST(CASE WHEN id < 30000 THEN id % 20000 ELSE -1 END AS STRING) AS feature", "CAST(id % 977 AS DOUBLE) AS value")
    got = {r["feature"]: (r["n"], r["q"]) for r in order_stats.exact_quantiles(rows, ["feature"], [0.25, 0.5], small_group=1000).collect()}
    want = rows.groupBy("feature").agg(F.count("*").alias("n"), F.percentile("value", F.array(F.lit(0.25), F.lit(0.5))).alias("q"))
    assert got == {r["feature"]: (r["n"], r["q"]) for r in want.collect()} and len(got) == 20_001


def test_boosting_leaves_no_copies(spark, two_shares):
    import os

    folder = staging.shared_folder(spark).removeprefix("file:") + "/retention"
    boosts = lambda: {f for f in os.listdir(folder) if f.startswith("boost-")} if os.path.isdir(folder) else set()
    before = boosts()
    boosting.BoostedTrees(rounds=6, maxDepth=1, stageEvery=2).fit(two_shares)
    assert boosts() == before
