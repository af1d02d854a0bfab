"""Customer table and score table derived from the order tables.

Every aggregate of ``customer_profile`` has a fixed-width buffer, so Spark
combines by hash before the shuffle; a customer holding a third of all orders
arrives as one partial row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Order priorities, lowest first in text order.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

# Multipliers of the three made-up scorers.
SCORERS = {"m1": 7919, "m2": 104729, "m3": 1299709}

# Stated schemas save a pass over the file footers.
CUSTOMER = "c_custkey bigint, c_nationkey int, c_acctbal double, c_mktsegment string"
ORDERS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"


def _yes_no(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'Yes' ELSE 'No' END"


def customer_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw customer row per customer, in the shape of the raw table."""
    customer = spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    orders = spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey",
        "o_custkey",
        "CAST(o_orderdate AS DATE) AS d",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS price",
        "o_orderpriority AS priority",
    )
    anchor = orders.agg(F.max("d")).scalar()

    # Latest order's priority, highest text on equal dates: day number and
    # position in one long, because a text buffer would force a sort aggregate.
    priorities = "array({})".format(", ".join(f"'{p}'" for p in PRIORITIES))
    aggregates = [
        "max(d) AS last_dt",
        f"min(CASE WHEN priority = '{PRIORITIES[0]}' THEN d END) AS first_urgent",
        "sum(price) AS total",
        "count(1) AS n",
        f"max(CAST(unix_date(d) AS BIGINT) * 8 + array_position({priorities}, priority)) AS latest",
        *[f"max(o_orderkey % 9 = {k}) AS s{k}" for k in range(9)],
    ]
    per_customer = orders.groupBy("o_custkey").agg(*[F.expr(a) for a in aggregates])
    joined = customer.join(per_customer, customer["c_custkey"] == per_customer["o_custkey"], "left")

    has = [f"coalesce(s{k}, false)" for k in range(9)]
    return joined.withColumn("anchor", anchor).selectExpr(
        "c_custkey AS customerID",
        "CASE WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender",
        "CAST(c_custkey % 6 = 0 AS INT) AS SeniorCitizen",
        f"{_yes_no('c_acctbal >= 4500')} AS Partner",
        f"{_yes_no('c_custkey % 10 < 3')} AS Dependents",
        "CAST(coalesce(floor(date_diff(anchor, first_urgent) / 30.0D), 0) AS INT) AS tenure",
        f"{_yes_no(has[0])} AS PhoneService",
        f"CASE WHEN NOT {has[0]} THEN 'No phone service' WHEN {has[1]} THEN 'Yes' ELSE 'No' END AS MultipleLines",
        f"CASE WHEN {has[2]} THEN 'Fiber' WHEN {has[3]} THEN 'DSL' ELSE 'No' END AS InternetService",
        f"{_yes_no(has[4])} AS OnlineSecurity",
        f"{_yes_no(has[5])} AS OnlineBackup",
        f"CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN {has[6]} THEN 'Yes' ELSE 'No' END AS DeviceProtection",
        f"{_yes_no(has[7])} AS TechSupport",
        f"{_yes_no(has[8])} AS StreamingTV",
        f"{_yes_no(f'{has[1]} AND {has[8]}')} AS StreamingMovies",
        "c_mktsegment AS Contract",
        f"{_yes_no('c_custkey % 5 < 3')} AS PaperlessBilling",
        f"coalesce(try_element_at({priorities}, CAST(latest % 8 AS INT)), 'none') AS PaymentMethod",
        "CASE WHEN c_custkey % 97 <> 0 THEN CAST(total AS DOUBLE) / (1000.0D * n) END AS MonthlyCharges",
        "CASE WHEN first_urgent IS NULL THEN ' ' ELSE CAST(total AS STRING) END AS TotalCharges",
        f"{_yes_no('last_dt IS NULL OR date_diff(anchor, last_dt) > 270')} AS Churn",
    )


def scored_profile(profile: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(customerID, Contract, keep…, model, label, p, prediction): three scorers per customer.

    The scores depend on id and label only, so evaluation needs no training.
    """
    scorers = ", ".join(f"struct('{name}' AS model, {k} AS k)" for name, k in SCORERS.items())
    return (
        profile.selectExpr(
            "customerID", "Contract", *keep, "CAST(Churn = 'Yes' AS INT) AS label", f"explode(array({scorers})) AS s"
        )
        .selectExpr(
            "customerID", "Contract", *keep, "s.model AS model", "label",
            "CAST((customerID * s.k) % 100 * 6 + CASE WHEN label = 1 THEN 300 ELSE 50 END AS DOUBLE) / 1000.0D AS p",
        )
        .selectExpr("*", "CAST(p >= 0.5D AS INT) AS prediction")
    )
