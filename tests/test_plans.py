"""Shape of the physical plans: what may run over raw rows at any scale."""

import pathlib
import re

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import __spark_entry__ as entry
from retention.operators import curves, metrics, prep, thresholds
from retention.operators import sampling as sa
from retention.operators import train as tr
from retention.operators.clean import clean
from retention.sources.profile import customer_profile, scored_profile
from retention.sources.staging import BROADCAST_ROWS, broadcast_if_small, new_path, stage
from retention.sources.tables import read_split, write_split

SF = "/root/testdata/sf0.001"
SLOW = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def cleaned(spark):
    return stage(clean(customer_profile(spark, SF)), "cleaned")


@pytest.fixture(scope="module")
def scored(spark):
    return stage(scored_profile(customer_profile(spark, SF)), "scored")


@pytest.mark.parametrize("name", [
    "clean_table", "engineer_features", "stratified_split", "stratified_folds", "fit_and_encode", "class_weights",
    "full_metrics", "metrics_by_segment", "roc_curve", "pr_summary", "threshold_sweep", "optimal_predictions",
    "prediction_table", "best_threshold_over_scores", "cv_summary", "category_by_target", "box_statistics", "density",
    "tenure_histogram", "churn_by_tenure", "churn_by_service", "boosting_reweight", "classification_report",
])
def test_no_python_and_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert [w for w in SLOW if w in text] == []


def test_profile_combines_by_hash_and_prunes(spark):
    text = plan(customer_profile(spark, SF))
    assert "SortAggregate" not in text and "partial_sum" in text
    narrow = plan(customer_profile(spark, SF).select("customerID", "Contract"))
    assert "o_totalprice" not in narrow and "c_acctbal" not in narrow


def test_split_and_folds_do_not_move_rows(cleaned):
    for df in (sa.stratified_split(cleaned), sa.stratified_folds(cleaned)):
        assert "Exchange" not in plan(df) and "Window" not in plan(df) and "Join" not in plan(df)
        assert len(re.findall("FileScan", plan(df))) == 1


def test_split_reads_one_folder(spark, cleaned):
    path = new_path(spark, "split")
    write_split(sa.stratified_split(cleaned).select("customerID", "tenure", "split"), path)
    text = plan(read_split(spark, path, "test").select("customerID"))
    assert re.search(r"PartitionFilters: \[[^]]*split[^]]*= test", text)
    assert "ReadSchema: struct<customerID:bigint>" in text


def test_encoding_and_scoring_are_narrow(spark, cleaned):
    model = prep.Preprocessor(categorical=["Contract"], numerical=["tenure"]).fit(cleaned)
    encoded = model.transform(cleaned)
    tree = tr.create_model("dt", {"max_depth": 2}).fit(encoded)
    lr = tr.create_model("lr", {"max_iter": 3}).fit(encoded)
    rows = tr.score(encoded.select("customerID", "Churn_Binary", "features"), {"dt": tree, "lr": lr})
    text = plan(rows)
    assert "Exchange" not in text and "Python" not in text
    assert re.search(r"ReadSchema: struct<customerID:bigint,tenure:int,Contract:string,Churn_Binary:int>", text)


def test_sweep_shuffles_buckets_only(scored):
    text = plan(thresholds.threshold_sweep(scored))
    assert "Window" not in text and "partial_count" in text
    assert len(re.findall("FileScan", text)) == 1
    assert "Contract" not in text  # only model, label and score are read


def test_running_counts_have_no_single_partition_window(scored):
    for rows_per_range in (10**9, 50):
        text = plan(curves.running_counts(scored, ["model"], rows_per_range=rows_per_range))
        windows = re.findall(r"Window \[.*", text)
        assert windows and all("model" in w for w in windows)
        assert "SinglePartition" not in text


def test_threshold_search_reuses_the_window_order(scored):
    text = plan(thresholds.best_over_scores(scored, ["f1", "precision"]))
    above_window = text[: text.index("Window [")]
    # The rows are sorted for the window; only its small result may be sorted again.
    assert "partial_min" in above_window
    assert "Sort [" not in above_window[above_window.index("partial_min"):]


def test_counts_combine_before_the_shuffle(scored):
    text = plan(metrics.confusion_counts(scored, ["model"]))
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")


def test_broadcasts_are_size_checked(spark):
    big = spark.range(50).select(F.col("id").alias("k"))
    assert "BroadcastHashJoin" in plan(spark.range(10**6).join(broadcast_if_small(big, 50), F.col("id") == F.col("k")))
    assert broadcast_if_small(big, 49) is big
    assert BROADCAST_ROWS <= 100_000


def test_class_vectors_keep_order(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert list(df.select(array_to_vector(F.array("b", "a")).alias("v")).first().v) == [2.0, 1.0]


def test_no_local_checkpoints_or_whole_tables_on_the_driver():
    root = pathlib.Path(entry.__file__).parent
    for path in root.glob("retention/**/*.py"):
        text = path.read_text()
        for word in ("localCheckpoint", ".toPandas(", "crossJoin", "toLocalIterator", ".rdd"):
            assert word not in text, (path, word)
