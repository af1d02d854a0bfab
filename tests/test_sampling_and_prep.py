import hashlib
import math
import statistics

import pytest
from pyspark.sql import functions as F

from retention.operators import order_stats as os_
from retention.operators import prep
from retention.operators import sampling as sa
from retention.operators.row_index import with_row_index
from retention.sources import staging


def labelled(spark, n=3000, parts=4):
    return spark.range(n).select(
        F.col("id").alias("customerID"), (F.col("id") % 7 < 2).cast("int").alias("Churn_Binary")
    ).repartition(parts)


def by_hand(n, cut):
    """{id: rank position within its class / cut} by a plain sort."""
    classes = {}
    for i in range(n):
        classes.setdefault(int(i % 7 < 2), []).append(i)
    out = {}
    for ids in classes.values():
        ids.sort(key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
        for rank, i in enumerate(ids, start=1):
            out[i] = cut(rank, len(ids))
    return out


@pytest.mark.parametrize("few_classes", [32, 0])
@pytest.mark.parametrize("max_bucket_rows", [10_000, 50, 1])
def test_split_is_exact_and_independent_of_partitions(spark, max_bucket_rows, few_classes):
    counts = sa.class_counts(labelled(spark))
    shares = {counts[c]: q for c, q in sa.rows_for_test(counts, 0.3).items()}
    want = by_hand(3000, lambda r, n: "test" if r <= shares[n] else "train")
    for parts in (1, 7):
        rows = sa.stratified_split(
            labelled(spark, parts=parts), few_classes=few_classes, max_bucket_rows=max_bucket_rows
        ).collect()
        assert {r.customerID: r.split for r in rows} == want


@pytest.mark.parametrize("few_classes", [32, 0])
@pytest.mark.parametrize("max_bucket_rows", [10_000, 1])
def test_folds(spark, max_bucket_rows, few_classes):
    want = by_hand(3000, lambda r, n: sum(r > n * f // 5 for f in range(1, 5)))
    rows = sa.stratified_folds(labelled(spark), 5, few_classes=few_classes, max_bucket_rows=max_bucket_rows).collect()
    assert {r.customerID: r.fold for r in rows} == want
    sizes = {}
    for r in rows:
        sizes[r.Churn_Binary, r.fold] = sizes.get((r.Churn_Binary, r.fold), 0) + 1
    for label in (0, 1):
        of_class = [sizes[label, f] for f in range(5)]
        assert max(of_class) - min(of_class) <= 1


@pytest.mark.parametrize("few_classes", [32, 0])
def test_folds_of_a_tiny_class(spark, few_classes):
    df = spark.createDataFrame([(i, int(i < 2)) for i in range(20)], "customerID long, Churn_Binary int")
    rows = sa.stratified_folds(df, 5, few_classes=few_classes).collect()
    tiny = [r.fold for r in rows if r.Churn_Binary == 1]
    assert len(tiny) == 2 and len(set(tiny)) == 2
    assert all(0 <= r.fold < 5 for r in rows)


@pytest.mark.parametrize("few_classes", [32, 0])
def test_split_with_missing_label_and_copies_of_one_id(spark, few_classes):
    rows = [(i, 0) for i in range(50)] + [(99, 1)] * 40 + [(i, 1) for i in range(100, 120)] + [(200, None)]
    df = spark.createDataFrame(rows, "customerID long, Churn_Binary int")
    out = sa.stratified_split(df, few_classes=few_classes, max_bucket_rows=5).collect()
    assert len(out) == len(rows)
    assert len({r.split for r in out if r.customerID == 99}) == 1
    assert [r.split for r in out if r.customerID == 200] == [None]


def test_two_thousand_classes(spark):
    """Classes of one to three rows and one that holds most; text labels."""
    label = F.when(F.col("id") < 4000, (F.col("id") * F.col("id") % 2003).cast("string")).otherwise("hot")
    df = spark.range(9000).select(F.col("id").alias("customerID"), label.alias("Churn_Binary"))
    ids = {}
    for r in df.collect():
        ids.setdefault(r.Churn_Binary, []).append(r.customerID)
    shares = sa.rows_for_test({c: len(v) for c, v in ids.items()}, 0.3)
    test, fold = {}, {}
    for c, v in ids.items():
        v.sort(key=lambda i: (hashlib.md5(f"42|{i}".encode()).hexdigest(), i))
        for rank, i in enumerate(v, start=1):
            test[i] = "test" if rank <= shares[c] else "train"
            fold[i] = sum(rank > len(v) * f // 5 for f in range(1, 5))
    assert len(ids) > 1000
    assert {r.customerID: r.split for r in sa.stratified_split(df, max_bucket_rows=100).collect()} == test
    assert {r.customerID: r.fold for r in sa.stratified_folds(df, 5, max_bucket_rows=100).collect()} == fold


def test_no_rows_at_all(spark):
    df = spark.createDataFrame([], "customerID long, Churn_Binary int")
    for few in (32, 0):
        assert sa.stratified_split(df, few_classes=few).collect() == []
        assert sa.stratified_folds(df, 5, few_classes=few).collect() == []


def test_append_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(2, 1), (2, 1)], "y int, x int")
    assert sorted(tuple(r) for r in sa.append_rows(a, b).collect()) == [(1, 2)] * 3


def quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = math.floor(at)
    return values[low] + (values[math.ceil(at)] - values[low]) * (at - low)


@pytest.mark.parametrize("small_group", [10**9, 400, 10])
def test_exact_quantiles_with_skew_ties_and_outliers(spark, small_group):
    a = [float(i * i % 9973) for i in range(3000)]
    b = [5.0] * 2000 + [float(i) for i in range(500)] + [1e300, -1e300]
    c = [7.25]
    df = spark.createDataFrame(
        [("a", v) for v in a] + [("b", v) for v in b] + [("c", v) for v in c], "feature string, value double"
    )
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = {
        r.feature: (r.n, r.q)
        for r in os_.exact_quantiles(df, ["feature"], probabilities, small_group, accuracy=100).collect()
    }
    for name, values in (("a", a), ("b", b), ("c", c)):
        assert got[name][0] == len(values)
        for p, v in zip(probabilities, got[name][1]):
            assert math.isclose(v, quantile(values, p), rel_tol=1e-12), (name, p)


def impute_table(spark):
    return spark.createDataFrame(
        [("train", 1.0, "b", 3.0, "x"), ("train", 2.0, "a", 3.0, "x"), ("train", 4.0, "a", 3.0, None),
         ("train", 10.0, "b", 3.0, "y"), ("train", None, None, 3.0, "y"), ("test", None, "zzz", 4.0, "x")],
        "split string, n double, t string, k double, u string",
    ).withColumn("none", F.lit(None).cast("string")).withColumn("nothing", F.lit(None).cast("double"))


@pytest.mark.parametrize("small_group", [1000, 1])
def test_numeric_statistics(spark, small_group):
    train = impute_table(spark).where("split = 'train'")
    got = {r.feature: r for r in prep.numeric_statistics(train, ["n", "k", "nothing"], small_group).collect()}
    filled = [1.0, 2.0, 4.0, 10.0, 3.0]
    assert got["n"].median == 3.0
    assert math.isclose(got["n"]["mean"], statistics.fmean(filled))
    assert math.isclose(got["n"]["std"], statistics.pstdev(filled))
    assert got["k"]["std"] == 0.0
    assert "nothing" not in got


def test_preprocessor(spark):
    table = impute_table(spark)
    est = prep.Preprocessor(numerical=["n", "k", "nothing"], categorical=["t", "u", "none"])
    encoded, model = prep.fit_and_encode(table, ("split",), est)
    assert model.feature_names == ["n", "k", "t_b", "u_y"]  # first category and empty columns left out
    modes = {c["name"]: c["mode"] for c in model.statistics["categorical"]}
    assert modes == {"t": "a", "u": "x"}  # ties go to the smallest value
    test = encoded.where("split = 'test'").first()
    assert test["t_b"] == 0.0  # an unseen category looks like the baseline
    assert math.isclose(test["n"], (3.0 - 4.0) / statistics.pstdev([1.0, 2.0, 4.0, 10.0, 3.0]))
    assert test["k"] == 1.0  # no spread: only centred
    vector = model.transform(table).where("split = 'test'").first()["features"]
    assert list(vector) == [test["n"], test["k"], test["t_b"], test["u_y"]]


def test_preprocessor_survives_saving(spark, tmp_path):
    model = prep.Preprocessor(numerical=["n"], categorical=["t"]).fit(impute_table(spark))
    model.write().overwrite().save(str(tmp_path / "prep"))
    again = prep.PreprocessorModel.load(str(tmp_path / "prep"))
    assert again.statistics == model.statistics


def test_row_index(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("k")).repartition(5)
    rows = with_row_index(df, ["k"]).orderBy("k").collect()
    assert [r.row_index for r in rows] == list(range(1000))


def test_categories_with_quotes_and_extreme_numbers(spark):
    values = ["a", "it's", 'say "x"', "back\\slash", "new\nline", "%s {0}", "ünï"]
    df = spark.createDataFrame([(v, float(i) * 1e-17) for i, v in enumerate(values)], "t string, n double")
    model = prep.Preprocessor(numerical=["n"], categorical=["t"]).fit(df)
    rows = {r.t: r for r in model.encode(df, ["t"]).collect()}
    names = model.feature_names
    assert len(names) == len(values)
    for v in values:
        assert [n for n in names[1:] if rows[v][n] == 1.0] == ([] if v == min(values) else [f"t_{v}"])
    assert abs(sum(r.n for r in rows.values())) < 1e-9


def test_wide_columns_are_sparse_and_equal_narrow_ones(spark, tmp_path):
    df = spark.range(600).select(
        F.col("id"),
        (F.col("id") % 7).cast("double").alias("n"),
        F.when(F.col("id") % 50 == 0, None).otherwise((F.col("id") * F.col("id") % 211).cast("string")).alias("many"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("two"),
        F.concat(F.lit("it's \\ "), (F.col("id") % 90).cast("string")).alias("odd"),
    )
    new = spark.createDataFrame([(1000, None, "never", "b", None), (1001, 1.0, "0", None, "x")], "id long, n double, many string, two string, odd string")
    columns = {"categorical": ["many", "two", "odd"], "numerical": ["n"]}
    narrow = prep.Preprocessor(**columns).fit(df)
    wide = prep.Preprocessor(**columns, wideFrom=80).fit(df)
    assert set(wide.wide) == {"many", "odd"} and not narrow.wide
    assert wide.feature_names == narrow.feature_names
    assert len(wide.getOrDefault("fitted")) < 1000 < len(narrow.getOrDefault("fitted"))
    wide.write().overwrite().save(str(tmp_path / "prep"))
    again = prep.PreprocessorModel.load(str(tmp_path / "prep"))
    assert again.dictionary_path.startswith(str(tmp_path))
    every = df.unionByName(new)
    want = {r.id: list(r.features.toArray()) for r in narrow.transform(every).collect()}
    for model in (wide, again):
        out = model.transform(every)
        assert out.columns == [*every.columns, "features"]
        assert {r.id: list(r.features.toArray()) for r in out.collect()} == want
    encoded = wide.encode(every, ["id"])
    assert encoded.columns == ["id", "n", "two_b", "many_vector", "odd_vector"]
    assert encoded.count() == 602


def test_plan_does_not_grow_with_the_categories(spark):
    def size(n):
        df = spark.range(n).select(F.col("id").cast("string").alias("c"))
        model = prep.Preprocessor(categorical=["c"], numerical=[]).fit(df)
        assert fitted_size(model) == n - 1
        return len(model.transform(df)._jdf.queryExecution().optimizedPlan().toString())

    def fitted_size(model):
        return sum(n - 1 for n in model.wide.values())

    assert abs(size(2_000) - size(20_000)) < 200


def test_cut_search_deals_its_rows_to_tasks_by_their_number(spark, monkeypatch):
    """Many classes: a task holds a share of the rows that does not grow with the table; the outcome stays."""
    rows = spark.range(6000).select(F.col("id").alias("customerID"), (F.col("id") * 7919 % 60).cast("int").alias("k"))
    rows = rows.unionByName(rows.where("customerID % 10 = 0"))  # copies fall on one side
    want = {
        name: sorted(map(tuple, f(rows, label="k", few_classes=100).collect()))
        for name, f in (("split", sa.stratified_split), ("folds", sa.stratified_folds))
    }
    monkeypatch.setattr(staging, "ROWS_PER_TASK", 200)
    assert staging.tasks_for(spark, 6600) == 33 and staging.tasks_for(spark, 0) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = []
    whole = sa._rows_of
    monkeypatch.setattr(sa, "_rows_of", lambda *a: (lambda t: dealt.append(t) or t)(whole(*a)))
    for name, f in (("split", sa.stratified_split), ("folds", sa.stratified_folds)):
        for limits in ({}, {"max_bucket_rows": 40}):
            assert sorted(map(tuple, f(rows, label="k", few_classes=1, **limits).collect())) == want[name]
    sizes = dealt[0].groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 20 and max(r["count"] for r in sizes) < 1000
