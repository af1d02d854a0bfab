"""Feature importances and tree nodes as rows. All inputs are fitted models, so all tables are small."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassificationModel, LogisticRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CLASS_NAMES
from ..sources.staging import new_path
from .train import is_share_model
from .voting import BoostVote


def _strengths(model: Transformer) -> list[float] | None:
    if is_share_model(model):
        model = model.stages[0]
    if isinstance(model, LogisticRegressionModel):
        return [abs(float(c)) for c in model.coefficients]
    if hasattr(model, "featureImportances"):
        return [float(v) for v in model.featureImportances.toArray()]
    return None


def _table(spark: SparkSession, names: Sequence[str], values: Sequence[float] | None) -> DataFrame:
    rows = [] if values is None else list(zip(names, values))
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def _mean(vectors: Sequence[Sequence[float]]) -> list[float]:
    return [sum(v) / len(vectors) for v in zip(*vectors)]


def feature_importance(spark: SparkSession, model: Transformer, names: Sequence[str]) -> DataFrame:
    """(feature, importance), strongest first. A vote shows its first member that has any."""
    if isinstance(model, PipelineModel):
        if isinstance(model.stages[-1], BoostVote):
            return ensemble_importance(spark, model, names)
        for member in model.stages[:-1]:
            if _strengths(member) is not None:
                return _table(spark, names, _strengths(member))
        return _table(spark, names, None)
    return _table(spark, names, _strengths(model))


def coefficient_table(spark: SparkSession, model: LogisticRegressionModel, names: Sequence[str]) -> DataFrame:
    """(feature, coefficient, absolute_importance), strongest first."""
    rows = [(n, float(c), abs(float(c))) for n, c in zip(names, model.coefficients)]
    return spark.createDataFrame(
        rows, "feature string, coefficient double, absolute_importance double"
    ).orderBy(F.desc("absolute_importance"), "feature")


def tree_importance(spark: SparkSession, model: DecisionTreeClassificationModel, names: Sequence[str]) -> DataFrame:
    return _table(spark, names, _strengths(model))


def ensemble_importance(spark: SparkSession, model: Transformer, names: Sequence[str]) -> DataFrame:
    """Forest: its own. Vote and boosted trees: plain mean over the members that have any."""
    if not isinstance(model, PipelineModel):
        return _table(spark, names, _strengths(model))
    found = [s for s in map(_strengths, model.stages[:-1]) if s is not None]
    return _table(spark, names, _mean(found) if found else None)


def tree_nodes(
    spark: SparkSession,
    model: DecisionTreeClassificationModel,
    names: Sequence[str],
    max_depth: int = 3,
    class_names: Sequence[str] = tuple(CLASS_NAMES),
) -> DataFrame:
    """One row per node down to ``max_depth``: (id, depth, parent, feature, threshold, impurity, class, gain).

    Read from the table the model writer produces; a level is found by joining
    the children of the level above.
    """
    shares = is_share_model(model)
    model = model.stages[0] if shares else model
    # A node of a regression tree on a 0/1 label holds the class share p; its gini impurity is 2 p (1 - p), twice the variance.
    scale = F.lit(2.0 if shares else 1.0)
    impurity = 2 * F.col("prediction") * (1 - F.col("prediction")) if shares else F.col("impurity")
    predicted = (F.col("prediction") > 0.5 if shares else F.col("prediction")).cast("int")
    path = new_path(spark, "tree")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    feature = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("split.featureIndex") + 1)
    split = F.col("leftChild") >= 0
    flat = nodes.select(
        "id",
        F.when(split, feature).alias("feature"),
        F.when(split, F.element_at("split.leftCategoriesOrThreshold", 1)).alias("threshold"),
        impurity.alias("impurity"),
        F.element_at(F.array(*[F.lit(c) for c in class_names]), predicted + 1).alias("class"),
        F.when(split, F.col("gain") * scale).alias("gain"),
        "leftChild",
        "rightChild",
    )
    level = flat.where(F.col("id") == 0).withColumns({"depth": F.lit(0), "parent": F.lit(None).cast("int")})
    found = level
    for depth in range(1, max_depth + 1):
        children = level.where(F.col("leftChild") >= 0).select(
            F.col("id").alias("parent"), F.explode(F.array("leftChild", "rightChild")).alias("child")
        )
        level = flat.join(children, flat["id"] == children["child"]).drop("child").withColumn("depth", F.lit(depth))
        found = found.unionByName(level)
    return found.select("id", "depth", "parent", "feature", "threshold", "impurity", "class", "gain")
