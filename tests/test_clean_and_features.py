import math

from pyspark.sql import functions as F

from retention.operators import clean as cl
from retention.operators import features as fe
from retention.sources.staging import new_path, stage
from retention.sources.tables import read_raw, read_split, write_predictions, write_raw_csv, write_split


def test_cleaning_edges(spark):
    texts = [" ", "", "abc", "NaN", "1.5d", "inf", " 12.5 ", "1e3", None]
    numbers = [0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 12.5, 1000.0, 0.0]
    senior = [0, 1, 2, None, 0, 1, 2, None, 0]
    churn = ["Yes", "No", None, "yes", "Yes", "No", None, "yes", "Yes"]
    df = spark.createDataFrame(
        list(zip(range(9), senior, texts, churn)), "customerID long, SeniorCitizen int, TotalCharges string, Churn string"
    )
    rows = cl.clean(df).orderBy("customerID").collect()
    assert [r.TotalCharges for r in rows] == numbers
    assert [r.SeniorCitizen for r in rows] == ["No", "Yes", None, None, "No", "Yes", None, None, "No"]
    assert [r.Churn_Binary for r in rows] == [1, 0, 0, 0, 1, 0, 0, 0, 1]
    only_parsed = cl.charges_to_number(df).orderBy("customerID").collect()
    assert [r.TotalCharges for r in only_parsed] == [None] * 6 + [12.5, 1000.0, None]


def test_column_selection(spark):
    df = spark.createDataFrame([(1, "a", "Yes", 1)], "customerID long, gender string, Churn string, Churn_Binary int")
    assert cl.drop_non_features(df).columns == ["customerID", "gender"]
    assert cl.drop_non_features(df, keep_id=False).columns == ["gender"]
    assert cl.select_existing(df, ["nope", "gender", "customerID"]).columns == ["gender", "customerID"]
    assert cl.select_existing(df, ["nope"]).columns == df.columns
    assert cl.select_existing(df, None).columns == df.columns


def test_tenure_bin_edges(spark):
    values = [-1, 0, 1, 12, 13, 24, 25, 60, 61, 72, 73, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, tenure int")
    rows = fe.add_tenure_groups(df).orderBy("id").collect()
    assert [r.tenure_group for r in rows] == [
        None, None, "0-12 months", "0-12 months", "13-24 months", "13-24 months", "25-36 months", "49-60 months",
        "61-72 months", "61-72 months", None, None,
    ]
    assert [r.tenure_group_ordinal for r in rows] == [None, None, 0, 0, 1, 1, 2, 4, 5, 5, None, None]
    assert rows[0]["tenure_group_0-12 months"] is False and rows[11]["tenure_group_61-72 months"] is False
    assert rows[2]["tenure_group_0-12 months"] is True


def test_service_count(spark):
    df = spark.createDataFrame(
        [("Yes", "No internet service", 1, None), ("No", "Yes", 0, "Yes"), (None, None, 5, "Fiber")],
        "PhoneService string, MultipleLines string, OnlineSecurity int, TechSupport string",
    )
    rows = fe.add_service_count(df).collect()
    assert [r.service_count for r in rows] == [2, 2, 5]
    assert [r.service_count_group for r in rows] == ["Basic", "Basic", "High"]
    assert rows[2].service_count_High is True and rows[2].service_count_None is False
    zero = fe.add_service_count(df, ["absent"]).first()
    assert (zero.service_count, zero.service_count_group) == (0, "None")
    groups = spark.range(11).select(F.col("id").alias("PhoneService"))
    got = [r.service_count_group for r in fe.add_service_count(groups, ["PhoneService"]).orderBy("service_count").collect()]
    assert got == ["None"] + ["Basic"] * 2 + ["Medium"] * 2 + ["High"] * 2 + ["Complete"] * 4


def test_interactions(spark):
    df = spark.createDataFrame(
        [(10, 4.0, "A", True), (10, -1.0, "A", False), (10, None, "B", True), (0, 0.0, "B", None)],
        "tenure int, MonthlyCharges double, Contract string, Contract_A boolean",
    )
    rows = fe.add_interactions(df).collect()
    assert [r.tenure_to_monthly_ratio for r in rows] == [2.0, None, None, 0.0]
    assert [r.Contract_A_tenure for r in rows] == [10, 0, 10, None]
    assert "Contract_tenure" not in rows[0].asDict()
    assert fe.add_interactions(df.select("MonthlyCharges")).columns == ["MonthlyCharges"]


def test_engineer_switches(spark):
    df = spark.createDataFrame([(5, 1.0, "Yes")], "tenure int, MonthlyCharges double, PhoneService string")
    assert fe.engineer(df, False, False, False).columns == df.columns
    assert fe.engineer(df, select=True).columns == ["tenure", "MonthlyCharges"]


def test_segment_mapping(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C D",), ("Z",), (None,)], "Contract string")
    got = {
        r.value: r.encoded_column
        for r in fe.segment_mapping(df, ["Contract", "absent"], {"Contract": ["A", "B", "C_D"]}).collect()
    }
    assert got == {"B": "Contract_B", "C D": "Contract_C_D"}


def test_raw_csv_keeps_blanks_and_reads_missing_tokens(spark):
    df = spark.createDataFrame(
        [("7-A", 1, 3, 20.5, " ", "NA"), ("8-B", None, None, None, "33.1", "none")],
        "customerID string, SeniorCitizen int, tenure int, MonthlyCharges double, TotalCharges string, PaymentMethod string",
    )
    back = read_raw(spark, write_raw_csv(df, new_path(spark, "raw")))
    rows = {r.customerID: r for r in back.collect()}
    assert rows["7-A"].TotalCharges == " " and rows["7-A"].PaymentMethod is None
    assert rows["8-B"].SeniorCitizen is None and rows["8-B"].PaymentMethod == "none"
    assert dict(back.dtypes)["tenure"] == "int" and dict(back.dtypes)["MonthlyCharges"] == "double"


def test_split_tables_and_predictions(spark):
    df = spark.createDataFrame([(1, "train", 0.25), (2, "test", 0.5)], "customerID long, split string, x double")
    for kind in ("parquet", "csv"):
        path = new_path(spark, "split")
        paths = write_split(df, path, kind)
        assert set(paths) == {"train", "test"}
        assert [int(r.customerID) for r in read_split(spark, path, "test", kind).collect()] == [2]
        assert read_split(spark, path, file_format=kind).count() == 2
    folder = new_path(spark, "results")
    first, second = write_predictions(df, folder), write_predictions(df, folder)
    assert first != second
    assert spark.read.option("header", True).csv(first).count() == 2


def test_stage_returns_the_same_rows(spark):
    df = spark.range(10).withColumn("x", F.col("id") / 3)
    assert sorted(stage(df, "t").collect()) == sorted(df.collect())
    assert math.isclose(stage(df, "t").agg(F.sum("x")).first()[0], 15.0)


def test_raw_numbers(spark):
    texts = ["3", "3.0", "3.5", "x", " 4 ", "NaN", None, "1e2", "99999999999"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "customerID string, tenure string")
    rows = read_raw(spark, write_raw_csv(df, new_path(spark, "raw"))).collect()
    got = {r.customerID: r.tenure for r in rows}
    assert [got[str(i)] for i in range(len(texts))] == [3, 3, None, None, 4, None, None, 100, None]
