import math
import threading
import types

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from retention.operators import boosting, curves, cv, tuning
from retention.operators import inspect_models as im
from retention.operators import train as tr
from retention.plans import jobs
from retention.sources.profile import customer_profile
from retention.sources.staging import new_path


@pytest.fixture(scope="module")
def linear(spark):
    i = F.col("id")
    x1 = (i * 7919 % 1009) / 504.5 - 1
    x2 = (i * 104729 % 997) / 498.5 - 1
    clear = (2 * x1 - x2 > 0).cast("int")
    df = spark.range(4000).select(
        i.alias("customerID"),
        F.when(i * 31 % 20 == 0, 1 - clear).otherwise(clear).alias("Churn_Binary"),
        array_to_vector(F.array(x1, x2)).alias("features"),
    )
    return df.cache()


@pytest.fixture(scope="module")
def stripes(spark):
    x = (F.col("id") * 2654435761 % 10007) / 10007
    return spark.range(4000).select(
        F.col("id").alias("customerID"),
        (F.floor(x * 4) % 2).cast("int").alias("Churn_Binary"),
        array_to_vector(F.array(x)).alias("features"),
    ).cache()


def accuracy(model, df):
    return model.transform(df).agg(F.avg((F.col("prediction") == F.col("Churn_Binary")).cast("double"))).first()[0]


def test_logistic_regression(linear):
    model = tr.train_logistic_regression(linear)
    scored = tr.score(linear, {"lr": model})
    assert curves.ranking_metrics(scored, ["model"]).first().auc > 0.9
    assert 1.8 < -model.coefficients[0] / model.coefficients[1] < 2.6
    # At the fit the gradient of C * sum(w * loss) + |b|^2 / 2 vanishes.
    counts = tr.class_counts(linear)
    w = tr.class_weight_column(tr.balanced_weights(counts), "Churn_Binary")
    p = vector_to_array("probability")[1]
    x = vector_to_array("features")
    residual = w * (p - F.col("Churn_Binary"))
    g = model.transform(linear).agg(F.sum(residual * x[0]), F.sum(residual * x[1]), F.sum(residual)).first()
    assert abs(g[0] + model.coefficients[0]) < 1 and abs(g[1] + model.coefficients[1]) < 1 and abs(g[2]) < 1


def test_balanced_weights(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "Churn_Binary int")
    assert {r.label: r.weight for r in tr.class_weight_table(df).collect()} == {0: pytest.approx(2 / 3), 1: 2.0}
    assert tr.balanced_weights(tr.class_counts(df)) == {0: pytest.approx(2 / 3), 1: 2.0}


def test_factory(linear):
    with pytest.raises(ValueError):
        tr.create_model("svm")
    shallow = tr.create_model("dt", {"max_depth": 1}).fit(linear)
    assert shallow.stages[0].depth == 1 and tr.create_model("dt").fit(linear).stages[0].depth == 5
    assert tr.create_model("rf", {"n_estimators": 7, "max_depth": 2}).fit(linear).stages[0].getNumTrees == 7
    assert tr.create_model("dt", {"max_depth": None}).fit(linear).stages[0].depth > 5


def test_stripes_need_depth_and_boosting_finds_them(stripes):
    tree = lambda d: accuracy(tr.create_model("dt", {"max_depth": d}).fit(stripes), stripes)
    assert tree(1) == pytest.approx(0.75, abs=0.01) and tree(3) > 0.99
    boosted = {n: accuracy(boosting.train_boosted(stripes, rounds=n, max_depth=1), stripes) for n in (1, 3, 12)}
    assert boosted[1] == pytest.approx(0.75, abs=0.01)
    assert boosted[1] < boosted[3] <= boosted[12] and boosted[12] > 0.99


def test_a_perfect_tree_ends_the_boosting(spark):
    df = spark.range(100).select(
        (F.col("id") >= 50).cast("int").alias("Churn_Binary"),
        array_to_vector(F.array(F.col("id").cast("double"))).alias("features"),
    )
    model = boosting.train_boosted(df, rounds=9)
    assert len(model.stages) == 3 and accuracy(model, df) == 1.0


def test_reweight(spark):
    df = spark.createDataFrame([(1, 0.8, 0.25), (0, 0.8, 0.25), (1, 0.5, 0.5)], "label int, p double, weight double")
    rows = boosting.reweight(df).collect()
    raw = [0.25 * 0.5, 0.25 * 2.0, 0.5]  # exp(-log(4)/2), exp(log(4)/2), 1
    assert [r.weight for r in rows] == pytest.approx([v / sum(raw) for v in raw])


def test_votes(linear):
    bases = tr.fit_all({k: tr.create_model(k) for k in tr.BASE_KINDS}, linear)
    models = {**bases, "hard": tr.vote_model(bases, "hard"), "soft": tr.vote_model(bases, "soft")}
    wide = tr.score_wide(linear, models)
    rows = wide.collect()
    alone = {
        kind: {r.customerID: r for r in tr.score_wide(linear, {kind: models[kind]}).collect()} for kind in ("hard", "soft")
    }
    for r in rows[:500]:
        votes = r.lr_prediction + r.dt_prediction + r.rf_prediction
        mean = (r.lr_probability + r.dt_probability + r.rf_probability) / 3
        assert r.hard_prediction == int(votes >= 2) and r.hard_probability is None
        assert r.soft_probability == pytest.approx(mean) and r.soft_prediction == int(mean > 0.5)
        # The saveable models agree with the votes read from the members' columns.
        assert alone["hard"][r.customerID].hard_prediction == r.hard_prediction
        assert alone["soft"][r.customerID].soft_probability == pytest.approx(mean)


@pytest.mark.parametrize("kind", ["lr", "dt", "rf", "hard", "soft", "boosted"])
def test_saved_models_score_alike(spark, linear, kind):
    model = {
        "lr": lambda: tr.train_logistic_regression(linear),
        "dt": lambda: tr.train_decision_tree(linear),
        "rf": lambda: tr.create_model("rf", {"n_estimators": 5}).fit(linear),
        "hard": lambda: tr.create_model("ensemble").fit(linear),
        "soft": lambda: tr.create_model("ensemble", {"voting": "soft"}).fit(linear),
        "boosted": lambda: boosting.train_boosted(linear, rounds=3),
    }[kind]()
    path = tr.save_model(model, f"{kind}_model", new_path(spark, "models"))
    both = tr.score_wide(linear, {"before": model, "after": tr.load_model(spark, path)})
    same = F.col("before_prediction").eqNullSafe(F.col("after_prediction")) & F.col("before_probability").eqNullSafe(
        F.col("after_probability")
    )
    assert both.where(~same).count() == 0


def test_importances(spark, linear):
    names = ["x1", "x2"]
    bases = tr.fit_all({k: tr.create_model(k) for k in tr.BASE_KINDS}, linear)
    lr = {r.feature: r for r in im.coefficient_table(spark, bases["lr"], names).collect()}
    assert lr["x1"].absolute_importance == abs(lr["x1"].coefficient) and lr["x2"].coefficient < 0
    dt = {r.feature: r.importance for r in im.tree_importance(spark, bases["dt"], names).collect()}
    assert sum(dt.values()) == pytest.approx(1)
    vote = tr.vote_model(bases, "hard")
    first = {r.feature: r.importance for r in im.feature_importance(spark, vote, names).collect()}
    assert first["x1"] == pytest.approx(lr["x1"].absolute_importance)
    rf = {r.feature: r.importance for r in im.ensemble_importance(spark, bases["rf"], names).collect()}
    mean = {r.feature: r.importance for r in im.ensemble_importance(spark, vote, names).collect()}
    assert mean["x1"] == pytest.approx((lr["x1"].absolute_importance + dt["x1"] + rf["x1"]) / 3)
    ordered = [r.importance for r in im.feature_importance(spark, bases["rf"], names).collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_tree_nodes(spark, linear):
    model = tr.train_decision_tree(linear)
    nodes = im.tree_nodes(spark, model, ["x1", "x2"], max_depth=2).collect()
    by_id = {r.id: r for r in nodes}
    assert by_id[0].depth == 0 and by_id[0].parent is None and by_id[0].feature in ("x1", "x2")
    assert max(r.depth for r in nodes) == 2 and len(nodes) == 7
    assert all(by_id[r.parent].depth == r.depth - 1 for r in nodes if r.parent is not None)


def test_grid_search(linear):
    assert len(tuning.grid_points("lr", tuning.LR_GRID)) == 22
    assert len(tuning.grid_points("dt", tuning.DT_GRID)) == 180
    assert len(tuning.grid_points("rf", tuning.RF_GRID)) == 270
    grid = {"max_depth": [1, 4], "class_weight": [None, "balanced"]}
    model, best, results = tuning.tune_decision_tree(linear, grid, 3)
    rows = results.collect()
    assert len(rows) == 12
    mean = {}
    for r in rows:
        mean.setdefault(r.parameters, []).append(r.f1)
    assert sum(mean[str(best)]) == max(sum(v) for v in mean.values())
    assert model.stages[0].depth <= best["max_depth"]


def test_cross_validation(spark):
    from retention.operators.clean import clean

    df = clean(customer_profile(spark, "/root/testdata/sf0.001"))

    class Broken(tr.Classifier):
        def _fit(self, dataset):
            raise RuntimeError("cannot fit")

    models = {
        "lr": tr.create_model("lr", {"C": 1.0, "max_iter": 5}),
        "dt": tr.create_model("dt", {"max_depth": 2}),
        "rf": tr.create_model("rf", {"n_estimators": 3}),
        "ensemble": tr.create_model("ensemble"),
        "broken": Broken(),
    }
    scored = cv.fold_scores(models, df, 2, train_scores=True)
    counts = {(r.model, r.part): r["count"] for r in scored.groupBy("model", "part").count().collect()}
    n = df.count()
    assert counts == {(m, p): n for m in ("lr", "dt", "rf", "ensemble") for p in ("train", "test")}
    metrics = cv.fold_metrics(scored, ("model", "fold", "part")).collect()
    assert len(metrics) == 16
    assert all((r.roc_auc is None) == (r.model == "ensemble") for r in metrics)


def test_whole_job(spark):
    raw = customer_profile(spark, "/root/testdata/sf0.001")
    out = new_path(spark, "job")
    cfg = jobs.JobConfig(
        models=("lr", "dt", "rf", "ensemble"), cv_folds=2, output_dir=out, use_engineered=True, tune_on="validation",
        include_baseline=False, run_cv=False, model_params={"rf": {"n_estimators": 3, "max_depth": 3}, "lr": {"max_iter": 5}},
    )
    result = jobs.run_job(raw, cfg)
    n = raw.count()
    assert result.data.split.count() == n
    test = result.evaluation.predictions.collect()
    assert len(test) == result.data.split.where("split = 'test'").count()
    assert {"CustomerID", "True_Churn", "lr_optimal_prediction", "ensemble_prediction"} <= set(test[0].asDict())
    assert "ensemble_probability" not in test[0].asDict()
    assert spark.read.option("header", True).csv(result.evaluation.predictions_path).count() == len(test)
    assert set(result.model.paths) == {"lr", "dt", "rf", "ensemble"}
    assert "service_count" in result.data.preprocessor.feature_names
    assert {r.segment for r in result.model.segments.collect()} == set(result.data.preprocessor.categories["Contract"][1:])
    assert "cross_validation" not in result.report and len(result.eda) == 9
    for path in result.table_paths.values():
        assert spark.read.parquet(path).columns
    with pytest.raises(ValueError):
        jobs.run_job(raw, jobs.JobConfig(models=("svm",)))


def test_predictions_without_an_id_get_an_index(spark, linear):
    model = tr.create_model("dt", {"max_depth": 2}).fit(linear)
    wide = tr.score_wide(linear.drop("customerID"), {"dt": model})
    rows = jobs.prediction_columns(wide, {"dt": model}, {"dt": 0.25}).collect()
    assert sorted(r.Index for r in rows) == list(range(4000))
    assert all(r.dt_optimal_prediction == int(r.dt_probability >= 0.25) for r in rows)
    assert not any(math.isnan(r.dt_probability) for r in rows)


def test_training_queries_run_the_operators_defaults(spark, monkeypatch):
    from retention import config
    from retention.operators import boosting, cv, tuning
    from retention.plans import jobs, registry

    seen, found = {}, registry.queries()
    results = spark.range(1)
    monkeypatch.setattr(registry, "vectors", lambda s, d: (None, None))
    monkeypatch.setattr(registry, "train_test", lambda s, d: (None, None, None))
    monkeypatch.setattr(registry, "cleaned", lambda s, d: None)
    monkeypatch.setattr(registry, "customer_profile", lambda s, d: None)
    monkeypatch.setattr(registry.tr, "score", lambda test, models: results)
    monkeypatch.setattr(tuning, "grid_search", lambda kind, df, grid, k: seen.update({kind: (grid, k)}) or (None, None, results))
    monkeypatch.setattr(boosting, "BoostedTrees", lambda **o: seen.update(rounds=o["rounds"]) or type("B", (), {"fit": lambda *_: None})())
    monkeypatch.setattr(cv, "fold_scores", lambda models, df, k, **o: seen.update(cv=(models, k)) or results)
    monkeypatch.setattr(cv, "fold_metrics", lambda *a: results)
    monkeypatch.setattr(jobs, "data_job", lambda raw, cfg: None)
    monkeypatch.setattr(jobs, "model_job", lambda data, cfg: None)
    monkeypatch.setattr(jobs, "evaluation_job", lambda d, m, cfg: seen.update(evaluation=cfg) or type("E", (), {"predictions": results}))
    monkeypatch.setattr(jobs, "run_job", lambda raw, cfg: seen.update(whole=cfg) or type("J", (), {"table_paths": {}, "report": {"model_comparison": results}}))
    monkeypatch.setattr(registry, "_contents", lambda s, paths: results, raising=False)
    for name in ("tune_logistic_regression", "tune_decision_tree", "tune_random_forest", "train_boosted", "cross_validate", "evaluation_job", "whole_job"):
        found[name](spark, "")
    folds = config.CV_FOLDS
    assert (seen["lr"], seen["dt"], seen["rf"]) == ((config.LR_GRID, folds), (config.DT_GRID, folds), (config.RF_GRID, folds))
    assert seen["rounds"] == 50
    models, k = seen["cv"]
    assert set(models) == set(tr.KINDS) and k == folds
    for cfg in (seen["evaluation"], seen["whole"]):
        assert tuple(cfg.models) == tuple(tr.KINDS) and cfg.cv_folds == folds and cfg.run_cv and cfg.run_thresholds
    assert seen["whole"].run_eda


def test_contents_of_the_written_tables(spark, sf_dir):
    from collections import Counter

    from retention.plans import registry

    for job in ("eda_job", "report_job"):
        rows = registry.queries()[f"{job}_contents"](spark, sf_dir).collect()
        counts = {r["table_name"]: r["n_rows"] for r in registry.queries()[job](spark, sf_dir).collect()}
        assert Counter(r["table_name"] for r in rows) == Counter({name: n for name, n in counts.items() if n})
        assert all(r["row"].startswith("{") for r in rows)


def test_boosting_takes_a_number_of_bins(stripes):
    """Stripes of a quarter need more cuts than two bins offer."""
    coarse, fine = (accuracy(boosting.train_boosted(stripes, 2, max_bins=b), stripes) for b in (2, 256))
    assert coarse < 0.8 and fine > 0.95


def test_result_tables_are_written_side_by_side(spark, tmp_path):
    both = threading.Barrier(2, timeout=60)

    class Waiting:
        """A table whose writer waits until another one writes too."""

        def __init__(self, rows):
            self.rows, self.write = rows, self

        def mode(self, how):
            return self

        def parquet(self, path):
            both.wait()
            self.rows.write.parquet(path)

    tables = {n: Waiting(spark.range(i)) for i, n in enumerate(("none", "one", "two", "three"))}
    paths = jobs.write_tables(tables, f"{tmp_path}/t/")
    assert paths == {n: f"{tmp_path}/t/{n}" for n in tables}
    assert [spark.read.parquet(p).count() for p in paths.values()] == [0, 1, 2, 3]


def test_exploratory_tables_are_made_beside_the_evaluation(monkeypatch):
    both = threading.Barrier(2, timeout=60)
    part = types.SimpleNamespace(cleaned=None, scored=None, metrics=None, cv_summary=None)

    def meet(value):
        both.wait()
        return value

    monkeypatch.setattr(jobs, "data_job", lambda raw, cfg: part)
    monkeypatch.setattr(jobs, "model_job", lambda data, cfg: part)
    monkeypatch.setattr(jobs, "evaluation_job", lambda data, model, cfg: meet(part))
    monkeypatch.setattr(jobs, "eda_tables", lambda table: meet({"a": table}))
    monkeypatch.setattr(jobs, "report_tables", lambda *rows: {})
    found = jobs.run_job(None)
    assert found.evaluation is part and found.eda == {"a": None}
