"""Votes over the outputs of several fitted models, as expressions and as model stages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Smallest probability used in a logarithm: the double precision step at 1.
PROBABILITY_FLOOR = 2.220446049250313e-16


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def hard_vote(predictions: Sequence[Column]) -> Column:
    """Class with the most votes, class 0 on a tie."""
    return (_sum([p.cast("int") for p in predictions]) * 2 > len(predictions)).cast("int")


def soft_vote(probabilities: Sequence[Column]) -> Column:
    """Mean probability of the positive class."""
    return _sum(list(probabilities)) / F.lit(float(len(probabilities)))


def predict_soft(probability: Column) -> Column:
    """Class with the larger probability, class 0 at exactly one half."""
    return (probability > 0.5).cast("int")


def log_odds(p: Column) -> Column:
    floor = F.lit(PROBABILITY_FLOOR)
    return F.log(F.greatest(p, floor)) - F.log(F.greatest(F.lit(1.0) - p, floor))


class _Combine(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Combines the columns ``{name}_probability`` / ``{name}_prediction`` of earlier stages."""

    names = Param(Params._dummy(), "names", "names of the combined models", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, names=None):
        super().__init__()
        if names is not None:
            self._set(names=names)

    def _columns(self, kind: str) -> list[Column]:
        return [F.col(f"{n}_{kind}") for n in self.getOrDefault(self.names)]

    def _drop_inputs(self, df: DataFrame) -> DataFrame:
        names = self.getOrDefault(self.names)
        return df.drop(*[f"{n}_{k}" for n in names for k in ("probability", "prediction")])

    @staticmethod
    def _with_probability(df: DataFrame, p: Column, prediction: Column) -> DataFrame:
        return df.withColumns({
            "probability": array_to_vector(F.array(F.lit(1.0) - p, p)),
            "prediction": prediction.cast("double"),
        })


class ShareScore(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Turns the class share that a tree or forest predicts into a probability and a prediction."""

    share = Param(Params._dummy(), "share", "column with the share of class 1", TypeConverters.toString)
    probabilityCol = Param(Params._dummy(), "probabilityCol", "probability vector", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "class, empty for none", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, share="share", probabilityCol="probability", predictionCol="prediction"):
        super().__init__()
        self._setDefault(share="share", probabilityCol="probability", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        share = self.getOrDefault(self.share)
        p = F.least(F.greatest(F.col(share), F.lit(0.0)), F.lit(1.0))
        added = {self.getOrDefault(self.probabilityCol): array_to_vector(F.array(F.lit(1.0) - p, p))}
        if self.getOrDefault(self.predictionCol):
            added[self.getOrDefault(self.predictionCol)] = predict_soft(p).cast("double")
        return dataset.withColumns(added).drop(share)


class HardVote(_Combine):
    """Majority of the predictions; has no probability."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self._drop_inputs(
            dataset.withColumn("prediction", hard_vote(self._columns("prediction")).cast("double"))
        )


class SoftVote(_Combine):
    """Mean of the probabilities."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p = soft_vote([vector_to_array(c)[1] for c in self._columns("probability")])
        return self._drop_inputs(self._with_probability(dataset, p, predict_soft(p)))


class BoostVote(_Combine):
    """Sigmoid of the mean log odds of the boosted trees."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        odds = [log_odds(vector_to_array(c)[1]) for c in self._columns("probability")]
        decision = _sum(odds) / F.lit(float(len(odds)))
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-decision))
        return self._drop_inputs(self._with_probability(dataset, p, decision > 0))
