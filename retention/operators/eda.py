"""The aggregates behind the exploratory charts. Results are small, inputs are scanned in place."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CATEGORICAL_FEATURES, ID_COLUMN, NUMERICAL_FEATURES, SERVICE_COLUMNS, TARGET, TENURE_BINS
from ..functions.scalar import bin_ordinal, is_positive, is_yes
from ..sources.staging import broadcast_if_small, stage
from .features import text_columns
from .order_stats import SMALL_GROUP, exact_quantiles, long_values
from .row_index import with_row_index

# Short labels of the tenure bins, and other names a target column may have.
SHORT_TENURE_LABELS = ["0-12", "13-24", "25-36", "37-48", "49-60", "61-72"]
TARGET_NAMES = ["Churn", "Churn_Binary", "target", "Target", "label", "Label", "y"]

HISTOGRAM_BINS = 12
KDE_POINTS = 100
KDE_CUT = 2.0
WHISKER = 1.5
FEW_VALUES = 500


def resolve_target(df: DataFrame, target: str = TARGET) -> str:
    """The target column, or the first other name that exists."""
    for name in [target, *TARGET_NAMES]:
        if name in df.columns:
            return name
    raise ValueError(f"Target column '{target}' not found")


def target_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """(value, count, percentage): the percentage is of all rows, missing targets included."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.where(F.col(target).isNotNull())
        .groupBy(F.col(target).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("percentage", F.bround(F.col("count").cast("double") / total * 100, 1))
        .orderBy(F.desc("count"), "value")
    )


def category_by_target(
    df: DataFrame, columns: Sequence[str] = tuple(CATEGORICAL_FEATURES), target: str = TARGET
) -> DataFrame:
    """(feature, value, target, count, percentage) for every value and target, 0 where none.

    All columns share one aggregation. Rows with a missing value or target are left out.
    """
    present = [c for c in columns if c in df.columns]
    counts = stage(  # read twice below
        df.where(F.col(target).isNotNull())
        .select(F.col(target).cast("string").alias("target"), *[F.col(c).cast("string").alias(c) for c in present])
        .unpivot(["target"], present, "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value", "target")
        .agg(F.count(F.lit(1)).alias("n")),
        "counts",
    )
    # Per (feature, value) one entry per target value.
    per_value = counts.groupBy("feature", "value").agg(
        F.map_from_entries(F.collect_list(F.struct("target", "n"))).alias("by_target"),
        F.sum("n").alias("total"),
    )
    per_feature = counts.groupBy("feature").agg(F.collect_set("target").alias("targets"))
    filled = (
        per_value.join(broadcast_if_small(per_feature), "feature")
        .select("feature", "value", "total", "by_target", F.explode("targets").alias("target"))
        .withColumn("count", F.coalesce(F.try_element_at("by_target", F.col("target")), F.lit(0)).cast("long"))
    )
    return filled.select(
        "feature", "value", "target", "count",
        (F.col("count").cast("double") / F.col("total").cast("double") * 100).alias("percentage"),
    )


def _numeric_by_target(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return long_values(
        df.where(F.col(target).isNotNull()).withColumn("target", F.col(target).cast("string")), present, ["target"]
    )


def box_statistics(
    df: DataFrame,
    columns: Sequence[str] = tuple(NUMERICAL_FEATURES),
    target: str = TARGET,
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """(feature, target, n, q1, median, q3, low_whisker, high_whisker, n_outliers)."""
    values = _numeric_by_target(df, columns, target)
    q = _quartiles(values, small_group)
    v = F.col("value")
    near = (v >= F.col("low_limit")) & (v <= F.col("high_limit"))
    return (
        values.join(q, ["target", "feature"])
        .groupBy("feature", "target", "n", "q1", "median", "q3")
        .agg(
            F.least(F.min(F.when(near, v)), F.col("q1")).alias("low_whisker"),
            F.greatest(F.max(F.when(near, v)), F.col("q3")).alias("high_whisker"),
            F.count(F.when(~near, 1)).alias("n_outliers"),
        )
    )


def _quartiles(values: DataFrame, small_group: int) -> DataFrame:
    q = exact_quantiles(values, ["target", "feature"], [0.25, 0.5, 0.75], small_group).select(
        "target", "feature", "n",
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("median"), F.col("q")[2].alias("q3"),
    )
    reach = F.lit(WHISKER) * (F.col("q3") - F.col("q1"))
    return broadcast_if_small(
        q.withColumns({"low_limit": F.col("q1") - reach, "high_limit": F.col("q3") + reach})
    )


def box_outliers(
    df: DataFrame,
    columns: Sequence[str] = tuple(NUMERICAL_FEATURES),
    target: str = TARGET,
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """(feature, target, value, count) of the values beyond the whiskers."""
    values = _numeric_by_target(df, columns, target)
    v = F.col("value")
    return (
        values.join(_quartiles(values, small_group), ["target", "feature"])
        .where((v < F.col("low_limit")) | (v > F.col("high_limit")))
        .groupBy("feature", "target", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def density(
    df: DataFrame,
    columns: Sequence[str] = tuple(NUMERICAL_FEATURES),
    target: str = TARGET,
    points: int = KDE_POINTS,
    cut: float = KDE_CUT,
) -> DataFrame:
    """(feature, target, i, x, density): exact Gaussian kernel density with Scott's bandwidth.

    The grid reaches ``cut`` bandwidths beyond the data. Rows are first counted
    by value; every distinct value then adds its count to all grid points inside
    its task, where the sums per point are combined. A group without spread
    yields its one value with density 1.
    """
    values = _numeric_by_target(df, columns, target)
    counted = values.groupBy("target", "feature", "value").agg(F.count(F.lit(1)).alias("c"))
    spread = values.groupBy("target", "feature").agg(
        F.expr("count(1) AS n"),
        F.expr("stddev_samp(value) * pow(CAST(count(1) AS DOUBLE), -0.2D) AS h"),
        F.expr("min(value) AS low"),
        F.expr("max(value) AS high"),
    )
    flat = F.col("low") == F.col("high")
    grid = spread.where(~flat).selectExpr(
        "target", "feature", "n", "h",
        f"low - {cut}D * h AS start",
        f"(high - low + {2 * cut}D * h) / {float(points - 1)}D AS step",
    )
    grid = broadcast_if_small(grid)
    sums = (
        counted.join(grid, ["target", "feature"])
        .selectExpr("target", "feature", "value", "c", "h", "start", "step", f"explode(sequence(0, {points - 1})) AS i")
        .selectExpr("target", "feature", "i", "c", "(start + i * step - value) / h AS z")
        .groupBy("target", "feature", "i")
        .agg(F.expr("sum(c * exp(-0.5D * z * z)) AS kernel"))
    )
    curves = sums.join(grid, ["target", "feature"]).selectExpr(
        "feature", "target", "i", "start + i * step AS x", "kernel / (n * h * sqrt(2.0D * pi())) AS density"
    )
    single = spread.where(flat).selectExpr("feature", "target", "0 AS i", "low AS x", "1.0D AS density")
    return curves.unionByName(single)


def category_codes(df: DataFrame, columns: Sequence[str], id_column: str = ID_COLUMN) -> DataFrame:
    """Replace text columns by codes 0, 1, … in order of first appearance, missing as -1.

    A table has no row order in Spark, so a value appears first at its smallest
    id. Columns with few values are coded by a lookup inside the scan; a column
    with many is joined on its value.
    """
    if not columns:
        return df
    text = {c: F.col(c).cast("string") for c in columns}
    estimate = df.agg(*[F.approx_count_distinct(text[c]).alias(c) for c in columns]).first()
    few = [c for c in columns if estimate[c] <= FEW_VALUES]
    many = [c for c in columns if c not in few]
    source = df.withColumn("__id", F.col(id_column))  # keeps the ids when the id itself is coded
    if few:
        firsts = (
            df.select(F.col(id_column).alias("id"), *[text[c].alias(c) for c in few])
            .unpivot(["id"], few, "feature", "value")
            .where(F.col("value").isNotNull())
            .groupBy("feature", "value")
            .agg(F.min("id").alias("first"))
        )
        order: dict[str, list] = {c: [] for c in few}
        for r in firsts.collect():  # at most a few hundred per column
            order[r["feature"]].append((r["first"], r["value"]))
        source = source.withColumns({
            c: F.coalesce(
                F.array_position(F.array(*[F.lit(v) for _, v in sorted(order[c])]), text[c]) - 1, F.lit(-1)
            ).cast("double") if order[c] else F.lit(-1.0)
            for c in few
        })
    for c in many:
        firsts = df.where(F.col(c).isNotNull()).groupBy(text[c].alias("value")).agg(F.min(id_column).alias("first"))
        codes = with_row_index(firsts, ["first", "value"], "code").select("value", "code")
        source = (
            source.withColumnRenamed(c, "value")
            .withColumn("value", F.col("value").cast("string"))
            .join(codes, "value", "left")
            .withColumn(c, F.coalesce(F.col("code"), F.lit(-1)).cast("double"))
            .drop("value", "code")
        )
    return source.drop("__id")


def correlation_matrix(df: DataFrame, id_column: str = ID_COLUMN) -> DataFrame:
    """(a, b, r) of the lower triangle: Pearson over the rows that have both values.

    Text columns enter by their codes. A scan finds the means,
    then the moments around them: all columns without gaps share one matrix of
    products, summed per row vector, and any other pair gets moments of its own. r is null
    where a column does not vary over the rows of its pair.
    """
    spark = df.sparkSession
    names = df.columns
    coded = category_codes(df, text_columns(df), id_column)
    numbers = stage(
        coded.select(*[F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)).alias(f"c{i}") for i, c in enumerate(names)]), "numbers"
    )
    seen = numbers.agg(F.count(F.lit(1)), *[F.avg(c) for c in numbers.columns], *[F.count(c) for c in numbers.columns]).first()
    total, means, present = seen[0], seen[1 : len(names) + 1], seen[len(names) + 1 :]
    # Values around their mean: the sums of squares then lose no digits.
    around = [F.col(c) - F.lit(0.0 if m is None else m) for c, m in zip(numbers.columns, means)]
    whole = [n == total for n in present]
    pairs = [(i, j) for i in range(len(names)) for j in range(i)]
    moments = {}
    for i, x in enumerate(around):
        if whole[i]:  # the same over the rows of every pair of columns without gaps
            moments |= {("low", i): F.min(x), ("high", i): F.max(x)}
    for i, j in pairs:
        if whole[i] and whole[j]:
            continue
        both = F.col(f"c{i}").isNotNull() & F.col(f"c{j}").isNotNull()
        x, y = F.when(both, around[i]), F.when(both, around[j])
        moments["cov", i, j] = F.covar_pop(x, y)
        for c, v in ((i, x), (j, y)):
            moments |= {("var", c, i, j): F.var_pop(v), ("low", c, i, j): F.min(v), ("high", c, i, j): F.max(v)}
    found = dict(zip(moments, numbers.agg(*moments.values()).first())) if pairs else {}
    full = [i for i in range(len(names)) if whole[i]]
    if total and len(full) > 1:
        vectors = numbers.select(array_to_vector(F.array(*[around[i] for i in full])).alias("v"))
        gram = Correlation.corr(vectors, "v").first()[0].toArray()
        found |= {("r", full[a], full[b]): float(gram[a, b]) for a in range(len(full)) for b in range(a)}
    rows = []
    for i, j in pairs:
        own = () if whole[i] and whole[j] else (i, j)
        low, high = [[found[side, c, *own] for c in (i, j)] for side in ("low", "high")]
        varies = None not in low and low[0] < high[0] and low[1] < high[1]
        r = None
        if varies and own:
            r = found["cov", i, j] / math.sqrt(found["var", i, i, j] * found["var", j, i, j])
        elif varies:
            r = found["r", i, j]
        rows.append((names[i], names[j], None if r is None else min(1.0, max(-1.0, r))))
    return spark.createDataFrame(rows, "a string, b string, r double")


def tenure_histogram(
    df: DataFrame, tenure: str = "tenure", target: str = TARGET, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """(bin, low, high, target, count): equal bins over the whole range, 0 where none."""
    rows = df.where(F.col(tenure).isNotNull() & F.col(target).isNotNull()).select(
        F.col(tenure).cast("double").alias("v"), F.col(target).cast("string").alias("target")
    )
    edges = df.agg(F.min(tenure).cast("double").alias("low"), F.max(tenure).cast("double").alias("high")).select(
        # A constant column gets a range of one around its value.
        F.struct(
            F.when(F.col("low") == F.col("high"), F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
            F.when(F.col("low") == F.col("high"), F.lit(1.0)).otherwise(F.col("high") - F.col("low")).alias("span"),
        ).alias("e")
    ).scalar()
    width = edges["span"] / F.lit(float(bins))
    counts = (
        rows.select("target", F.least(F.floor((F.col("v") - edges["low"]) / width), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("target", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    per_target = counts.groupBy("target").agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("m"))
    return per_target.select(
        "target", "m", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "bin",
        (edges["low"] + F.col("bin") * width).alias("low"),
        (edges["low"] + (F.col("bin") + 1) * width).alias("high"),
        "target",
        F.coalesce(F.try_element_at("m", F.col("bin")), F.lit(0)).cast("long").alias("count"),
    )


def churn_by_tenure(df: DataFrame, tenure: str = "tenure", target: str = TARGET) -> DataFrame:
    """(position, tenure_group, customers, churn_rate) for all six groups; rate 0 in an empty one."""
    rates = (
        df.select(bin_ordinal(tenure, TENURE_BINS).alias("position"), is_positive(df, target).alias("yes"))
        .where(F.col("position").isNotNull())
        .groupBy("position")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            (F.avg(F.col("yes").cast("double")) * 100).alias("churn_rate"),
        )
    )
    labels = df.sparkSession.createDataFrame(list(enumerate(SHORT_TENURE_LABELS)), "position int, tenure_group string")
    return labels.join(rates, "position", "left").select(
        "position",
        "tenure_group",
        F.coalesce("customers", F.lit(0)).cast("long").alias("customers"),
        F.coalesce("churn_rate", F.lit(0.0)).alias("churn_rate"),
    )


def churn_by_service(
    df: DataFrame, columns: Sequence[str] = tuple(SERVICE_COLUMNS), target: str = TARGET
) -> DataFrame:
    """(Service, With Service, Without Service): churn rates in percent.

    A missing value counts as without; a column without any 'Yes' is left out.
    """
    present = [c for c in columns if c in df.columns]
    churned = F.col("target").cast("double") * 100
    has = is_yes(F.col("value"))
    return (
        df.select(is_positive(df, target).alias("target"), *[F.col(c).cast("string").alias(c) for c in present])
        .unpivot(["target"], present, "Service", "value")
        .groupBy("Service")
        .agg(
            F.avg(F.when(has, churned)).alias("With Service"),
            F.avg(F.when(~has, churned)).alias("Without Service"),
        )
        .where(F.col("With Service").isNotNull())
    )


def service_long(wide: DataFrame) -> DataFrame:
    """(Service, Status, Churn Rate (%))."""
    return wide.unpivot(["Service"], ["With Service", "Without Service"], "Status", "Churn Rate (%)")


def eda_tables(
    df: DataFrame,
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
    numerical: Sequence[str] = tuple(NUMERICAL_FEATURES),
    services: Sequence[str] = tuple(SERVICE_COLUMNS),
    target: str = TARGET,
) -> dict[str, DataFrame]:
    """All exploratory tables of a cleaned customer table, by name."""
    target = resolve_target(df, target)
    by_service = churn_by_service(df, services, target)
    return {
        "target_distribution": target_distribution(df, target),
        "category_by_target": category_by_target(df, categorical, target),
        "box_statistics": box_statistics(df, numerical, target),
        "box_outliers": box_outliers(df, numerical, target),
        "density": density(df, numerical, target),
        "correlation_matrix": correlation_matrix(df),
        "tenure_histogram": tenure_histogram(df, "tenure", target),
        "churn_by_tenure": churn_by_tenure(df, "tenure", target),
        "churn_by_service": service_long(by_service),
    }
