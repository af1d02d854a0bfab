import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import SparseVector
from pyspark.sql import functions as F

from retention.operators import grown, nested, tuning
from retention.operators import train as tr
from retention.operators.metrics import CONFUSION, confusion_counts


@pytest.fixture(scope="module")
def noisy(spark):
    i = F.col("id")
    x = [(i * m % 1009) / 1009.0 for m in (7919, 104729, 611953)]
    side = (x[0] + x[1] * x[2] > 0.7).cast("int")
    return spark.range(3000).select(
        i.alias("customerID"),
        F.when(i * 37 % 11 < 2, 1 - side).otherwise(side).alias("Churn_Binary"),
        array_to_vector(F.array(*x)).alias("features"),
    ).cache()


def fitted(df, kind, **options):
    counts = {r[0]: r[1] for r in df.groupBy("Churn_Binary").count().collect()}
    return tr.fit_base(df, kind, options, counts)


def counts_of(model, df):
    said = model.transform(df).select(F.col("Churn_Binary").alias("label"), "prediction").withColumn("k", F.lit(0))
    return confusion_counts(said, ["k"]).select(*CONFUSION).first()


def bare(model):
    return model.stages[0] if tr.is_share_model(model) else model


@pytest.mark.parametrize("criterion", ["gini", "entropy"])
@pytest.mark.parametrize("weights", [None, "balanced"])
def test_a_cut_tree_is_the_tree_of_that_depth(noisy, criterion, weights):
    same = {"criterion": criterion, "class_weight": weights, "min_samples_leaf": 2}
    deep = bare(fitted(noisy, "dt", max_depth=None, **same))
    cuts = {0: (1, 2, 1), 1: (3, 2, 1), 2: (6, 2, 1), 3: (30, 2, 1), 4: (0, 2, 1)}
    found = {r["point"]: r for r in nested.cut_confusion(deep, noisy, cuts, "Churn_Binary").collect()}
    for point, depth in ((0, 1), (1, 3), (2, 6), (3, None), (4, 0)):
        want = counts_of(fitted(noisy, "dt", max_depth=depth, **same), noisy)
        assert [found[point][c] for c in CONFUSION] == list(want)


def test_first_trees_and_depths_of_a_forest(noisy):
    """A forest cut at a depth is the forest of that depth, its prefix the mean of its first trees."""
    deep = bare(fitted(noisy, "rf", n_estimators=6, max_depth=7))
    cuts = {0: (3, 2, 6), 1: (7, 2, 6), 2: (7, 2, 2)}
    found = {r["point"]: r for r in nested.cut_confusion(deep, noisy, cuts, "Churn_Binary").collect()}
    for point, depth in ((0, 3), (1, 7)):
        want = counts_of(fitted(noisy, "rf", n_estimators=6, max_depth=depth), noisy)
        assert [found[point][c] for c in CONFUSION] == list(want)
    rows = noisy
    for i in (0, 1):
        rows = deep.trees[i].copy().setPredictionCol(f"t{i}").transform(rows)
    said = rows.select(
        F.col("Churn_Binary").alias("label"), ((F.col("t0") + F.col("t1")) / 2 > 0.5).cast("int").alias("prediction"), F.lit(0).alias("k")
    )
    assert [found[2][c] for c in CONFUSION] == list(confusion_counts(said, ["k"]).select(*CONFUSION).first())


@pytest.mark.parametrize("kind", ["dt", "rf"])
def test_small_nodes_are_not_split(spark, noisy, kind, tmp_path):
    options = {"max_depth": 9, **({"n_estimators": 3} if kind == "rf" else {})}
    whole, cut = (bare(fitted(noisy, kind, min_samples_split=s, **options)) for s in (2, 200))
    nodes = {}
    for name, model in (("whole", whole), ("cut", cut)):
        model.write().save(str(tmp_path / name))
        nodes[name] = nested.flat_nodes(spark, str(tmp_path / name)).toPandas()
    assert (nodes["whole"].query("leftChild >= 0").rawCount < 200).any()
    assert (nodes["cut"].query("leftChild >= 0").rawCount >= 200).all()
    # Every node that 200 rows or more may split is still split, at the same place.
    for column in ("rawCount", "prediction", "gain"):
        assert sorted(nodes["cut"].query("leftChild >= 0")[column]) == sorted(
            nodes["whole"].query("leftChild >= 0 and rawCount >= 200")[column]
        )
    assert len(nodes["cut"].query("leftChild < 0")) == len(nodes["cut"].query("leftChild >= 0")) + (3 if kind == "rf" else 1)
    found = nested.cut_confusion(whole, noisy, {0: (9, 200, 3 if kind == "rf" else 1)}, "Churn_Binary").first()
    assert [found[c] for c in CONFUSION] == list(counts_of(tr.share_model(cut), noisy))


def test_smallest_split():
    assert [nested.smallest_split(v, 1000) for v in (None, 2, 5, 0.1, 0.0001)] == [2, 2, 5, 100, 2]


def test_one_fit_per_nest():
    points = tuning.grid_points("rf", tuning.RF_GRID)
    assert sorted(i for n in tuning.nests("rf", points) for i in n) == list(range(270))
    assert len(tuning.nests("rf", points)) == 6
    assert len(tuning.nests("dt", tuning.grid_points("dt", tuning.DT_GRID))) == 12
    assert len(tuning.nests("lr", tuning.grid_points("lr", tuning.LR_GRID))) == 22


def test_grid_over_nests_equals_single_fits(noisy):
    grid = {"max_depth": [2, 6], "min_samples_split": [2, 300], "min_samples_leaf": [1, 4]}
    best, options, results = tuning.tune_decision_tree(noisy, grid, 2)
    rows = results.collect()
    assert len(rows) == 16
    folded = tuning.stratified_folds(noisy, 2)
    for r in rows:
        options = eval(r.parameters)
        model = fitted(folded.where(F.col("fold") != r.fold), "dt", **options)
        tn, fp, fn, tp = counts_of(model, folded.where(F.col("fold") == r.fold))
        assert r.recall == tp / (tp + fn) and r.accuracy == (tp + tn) / (tp + tn + fp + fn)
    assert bare(best).depth <= 6


@pytest.mark.parametrize("kind", ["dt", "rf"])
@pytest.mark.parametrize("criterion", ["gini", "entropy"])
def test_deep_trees_keep_the_node_of_every_row(noisy, kind, criterion):
    """Else the grown trees go to every task at every level."""
    few = {"n_estimators": 2} if kind == "rf" else {}
    for depth, kept in ((None, True), (12, True), (5, False)):
        assert bare(fitted(noisy, kind, max_depth=depth, criterion=criterion, **few)).getCacheNodeIds() is kept


@pytest.mark.parametrize("few, tasks", [(100, 2), (10_000, None)])
def test_tasks_of_a_fit_follow_its_rows(noisy, monkeypatch, few, tasks):
    seen = []

    def fit(dataset, *rest):
        seen.append(dataset.rdd.getNumPartitions())
        return tr.fit_base(dataset, *rest)

    monkeypatch.setattr(tuning, "fit_base", fit)
    monkeypatch.setattr(tuning, "TREE_ROWS", 1000)
    monkeypatch.setattr(tuning, "FEW_ROWS", few)
    wide = noisy.repartition(16)
    folded = tuning.stratified_folds(wide, 2)
    train, holdout = folded.where(F.col("fold") == 0), folded.where(F.col("fold") == 1)
    counts = {r[0]: r[1] for r in train.groupBy("Churn_Binary").count().collect()}
    points = tuning.grid_points("dt", {"max_depth": [2, 4]})
    rows = tuning.nest_confusion("dt", train, holdout, points, [0, 1], counts, "Churn_Binary", "features")
    assert sum(rows[0][c] for c in CONFUSION) == holdout.count()
    assert seen == [tasks or train.rdd.getNumPartitions()] and train.rdd.getNumPartitions() > 2


def test_tasks_of_a_logistic_fit_follow_its_rows(noisy, monkeypatch):
    seen = []

    def fit(dataset, kind, options, counts, *rest):
        model = tr.fit_base(dataset, kind, options, counts, *rest)
        seen.append((dataset.rdd.getNumPartitions(), {type(r[0]) for r in dataset.select("features").collect()}))
        return model

    monkeypatch.setattr(tuning, "fit_base", fit)
    monkeypatch.setattr(tuning, "FIT_ROWS", 1000)
    monkeypatch.setattr(tuning, "FEW_ROWS", 100)
    flags = F.transform(F.sequence(F.lit(2), F.lit(12)), lambda m: (F.col("customerID") % m == 1).cast("double"))
    vector = array_to_vector(F.concat(vector_to_array("features"), flags))
    rows = noisy.select("customerID", "Churn_Binary", vector.alias("features")).repartition(16)
    model, best, results = tuning.grid_search("lr", rows, {"C": [0.1, 1.0]}, 2)
    assert len(seen) == 5 and all(n <= 2 and SparseVector in kinds for n, kinds in seen[:4])
    assert results.count() == 4 and best["C"] in (0.1, 1.0)
    folded = tuning.stratified_folds(rows, 2)
    counts = {r[0]: r[1] for r in rows.groupBy("Churn_Binary").count().collect()}
    plain = tr.fit_base(folded, "lr", {"max_iter": 1000, **best}, counts)
    assert abs(plain.coefficients.toArray() - model.coefficients.toArray()).max() < 1e-6


# --- trees grown by single tasks ------------------------------------------------------------------------------
def coarse(spark, parts=3):
    """600 labelled rows of few distinct values, and one without a label."""
    rows = []
    for i in range(601):
        x = [float(i * 7919 % 11), float(i * 104729 % 13 // 6), float(i % 2)]
        label = int((i * 31 + 7 * i // 3) % 10 < 2 + x[0] / 2 + 2 * x[1]) if i < 600 else None
        rows.append((str(i), label, x))
    table = spark.createDataFrame(rows, "customerID string, Churn_Binary int, x array<double>").repartition(parts)
    return table.select("customerID", "Churn_Binary", array_to_vector("x").alias("features"))


def searched(monkeypatch, search, table, grid, cells=grown.MOST_CELLS):
    monkeypatch.setattr(tuning, "FEW_ROWS", 100)
    monkeypatch.setattr(grown, "MOST_CELLS", cells)
    return {(r["point"], r["fold"]): tuple(r)[3:] for r in search(table, grid, 2)[2].collect()}


TREES = {"max_depth": [1, 3, None], "min_samples_split": [2, 0.1], "min_samples_leaf": [1, 6], "criterion": ["gini"], "class_weight": [None]}


def test_trees_grown_by_a_task_are_those_of_spark_ml(spark, monkeypatch):
    by_spark = searched(monkeypatch, tuning.tune_decision_tree, coarse(spark), TREES, 0)
    monkeypatch.setattr(tuning, "nest_confusion", None)  # no job per level
    assert searched(monkeypatch, tuning.tune_decision_tree, coarse(spark), TREES) == by_spark and len(by_spark) == 24


def test_entropy_and_weighted_trees_are_close_to_those_of_spark_ml(spark, monkeypatch):
    grid = {**TREES, "max_depth": [2], "criterion": ["gini", "entropy"], "class_weight": [None, "balanced"]}
    by_spark = searched(monkeypatch, tuning.tune_decision_tree, coarse(spark), grid, 0)
    by_task = searched(monkeypatch, tuning.tune_decision_tree, coarse(spark), grid)
    assert by_task.keys() == by_spark.keys()  # splits of equal gain may differ by the rounding of weights
    assert all(abs(a - b) < 0.1 for k in by_spark for a, b in zip(by_task[k], by_spark[k]))


def test_forests_grown_by_tasks_do_not_depend_on_the_layout(spark, monkeypatch):
    grid = {"n_estimators": [3, 7], "max_depth": [2, None], "min_samples_split": [2, 20], "class_weight": [None, "balanced"]}
    monkeypatch.setattr(tuning, "nest_confusion", None)
    whole = searched(monkeypatch, tuning.tune_random_forest, coarse(spark), grid)
    monkeypatch.setattr(grown, "BLOCK_TREES", 2)
    assert searched(monkeypatch, tuning.tune_random_forest, coarse(spark, 7), grid) == whole and len(whole) == 32


def test_one_tree_with_all_features_is_a_decision_tree(spark, monkeypatch):
    one = {"max_depth": [3], "min_samples_leaf": [2]}
    forest = searched(monkeypatch, tuning.tune_random_forest, coarse(spark), {**one, "n_estimators": [1], "max_features": [None]})
    assert forest == searched(monkeypatch, tuning.tune_decision_tree, coarse(spark), one)


def test_grown_tree_counts_every_drawn_row(monkeypatch):
    bins = np.array([[0, 0, 1, 1, 2, 2], [0, 1, 0, 1, 0, 1]], np.uint8)
    y = np.array([0, 0, 0, 1, 1, 1], np.uint8)
    rows = np.array([0, 0, 1, 2, 3, 4, 4, 5])
    tree = grown.grow(bins, np.array([3, 2]), y, rows, (1.0, 1.0), 30, 1)
    ended = grown.leaf_of(tree, bins, np.arange(6))
    assert tree["zeros"][0] == 4 and tree["ones"][0] == 4 and tree["left"][0] == 1
    says = grown.cut_values(tree, ended, (1.0, 1.0), False, [(0, 2), (30, 2), (30, 9)])
    assert says[:, 0].tolist() == [0.5] * 6 and says[:, 1].tolist() == y.tolist() and says[:, 2].tolist() == [0.5] * 6


def test_thresholds_lie_between_values_or_at_strides():
    assert grown.thresholds(np.array([3.0, 1.0, 1.0, 2.0]), 128).tolist() == [1.5, 2.5]
    assert grown.thresholds(np.arange(100.0), 4).tolist() == [24.5, 49.5, 74.5]
    assert len(grown.thresholds(np.array([5.0, 5.0]), 4)) == 0
