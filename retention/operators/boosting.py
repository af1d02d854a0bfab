"""Boosted shallow trees with real-valued class probabilities (Zhu et al. 2009, SAMME.R)."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LABEL, SEED
from ..sources.staging import stage_for_now
from .train import MAX_BINS
from .voting import BoostVote, ShareScore, log_odds


def weight_exponent(label: Column, margin: Column, learning_rate: float) -> Column:
    """Log weight of a row after trees whose log odds add up to ``margin``."""
    return F.lit(-0.5 * learning_rate) * (F.lit(2.0) * label - F.lit(1.0)) * margin


def reweight(
    df: DataFrame,
    weight: str = "weight",
    label: str = "label",
    probability: str = "p",
    learning_rate: float = 1.0,
) -> DataFrame:
    """One reweighting step: rows the model gets wrong gain weight; the weights sum to 1."""
    raised = df.withColumn(
        weight,
        F.col(weight)
        * F.exp(weight_exponent(F.col(label).cast("double"), log_odds(F.col(probability)), learning_rate)),
    )
    total = raised.agg(F.sum(weight)).scalar()
    return raised.withColumn(weight, F.col(weight) / total)


class BoostedTrees(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """The margin (sum of log odds so far) of every row is kept as a column; a
    weight is exp(exponent - largest exponent), which cannot overflow. Every few
    rounds the rows are written to the shared folder, so the plan stays short
    and a lost executor does not replay earlier rounds; the copy before is deleted."""

    rounds = Param(Params._dummy(), "rounds", "number of trees", TypeConverters.toInt)
    learningRate = Param(Params._dummy(), "learningRate", "step size", TypeConverters.toFloat)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature", TypeConverters.toInt)
    stageEvery = Param(Params._dummy(), "stageEvery", "rounds between written tables", TypeConverters.toInt)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 column", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, rounds=50, learningRate=1.0, maxDepth=3, maxBins=MAX_BINS, stageEvery=5, featuresCol="features",
        labelCol=LABEL,
    ):
        super().__init__()
        self._setDefault(
            rounds=50, learningRate=1.0, maxDepth=3, maxBins=MAX_BINS, stageEvery=5, featuresCol="features", labelCol=LABEL
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        get = self.getOrDefault
        rate, rounds = get(self.learningRate), get(self.rounds)
        features, label = get(self.featuresCol), get(self.labelCol)
        rows, delete = stage_for_now(
            dataset.where(F.col(label).isNotNull()).select(
                F.col(features).alias("features"),
                F.col(label).cast("double").alias("label"),
                F.lit(0.0).alias("margin"),
            ),
            "boost",
        )
        # A regression tree on the 0/1 label keeps the class share of every leaf.
        tree = DecisionTreeRegressor(
            maxDepth=get(self.maxDepth),
            maxBins=get(self.maxBins),
            seed=SEED,
            weightCol="weight",
            predictionCol="share",
        )
        exponent = weight_exponent(F.col("label"), F.col("margin"), rate)
        largest, members = 0.0, []
        for i in range(rounds):
            weighted = rows.withColumn("weight", F.exp(exponent - F.lit(largest)))
            model = tree.fit(weighted)
            p = F.col("share")
            wrong = ((p > 0.5).cast("double") != F.col("label")).cast("double")
            moved = model.transform(weighted).select(
                "features",
                "label",
                (F.col("margin") + log_odds(p)).alias("margin"),
                "weight",
                wrong.alias("wrong"),
            )
            member = model.copy()
            member.setFeaturesCol(features)
            member.setPredictionCol(f"tree{i}_share")
            members += [member, ShareScore(share=f"tree{i}_share", probabilityCol=f"tree{i}_probability", predictionCol="")]
            if i + 1 == rounds:
                break
            if (i + 1) % get(self.stageEvery) == 0:
                moved, delete_moved = stage_for_now(moved, "boost")
                delete()  # the new copy needs the old one no more
                delete = delete_moved
            error, largest = moved.agg(F.sum(F.col("weight") * F.col("wrong")), F.max(exponent)).first()
            if not error:  # a perfect tree ends the rounds
                break
            rows = moved.select("features", "label", "margin")
        delete()
        return PipelineModel([*members, BoostVote(names=[f"tree{i}" for i in range(len(members) // 2)])])


def train_boosted(
    df: DataFrame, rounds: int = 50, learning_rate: float = 1.0, max_depth: int = 3, label: str = LABEL,
    features: str = "features", max_bins: int = MAX_BINS,
) -> PipelineModel:
    return BoostedTrees(
        rounds=rounds, learningRate=learning_rate, maxDepth=max_depth, maxBins=max_bins, labelCol=label, featuresCol=features
    ).fit(df)
