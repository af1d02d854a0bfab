"""Cross-validation of many models with several metrics."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CV_FOLDS, CV_METRICS, ID_COLUMN, LABEL, SEED
from ..sources.staging import stage, stage_for_now
from .metrics import full_metrics
from .prep import Preprocessor
from .sampling import stratified_folds
from .train import BASE_KINDS, Classifier, run_parallel, score, vote_model

log = logging.getLogger(__name__)
MODEL_FAULTS = (ValueError, TypeError, RuntimeError, IllegalArgumentException, AnalysisException)


def fold_scores(
    models: Mapping[str, Estimator],
    df: DataFrame,
    k: int = CV_FOLDS,
    preprocessor: Preprocessor | None = None,
    label: str = LABEL,
    seed: int = SEED,
    train_scores: bool = False,
    threads: int = 3,
    fold_threads: int = 3,
) -> DataFrame:
    """Scored rows of every hold-out fold: (customerID, fold, part, model, label, p, prediction).

    Preprocessing is fitted inside each fold. A default vote is composed of the
    fold's own lr, dt and rf, which are fitted once. A model that fails in any
    fold is logged and left out.
    """
    folded, delete_folds = stage_for_now(stratified_folds(df, k, seed, label=label), "folds", partition_by="fold")
    failed: set[str] = set()

    def one_fold(f: int) -> DataFrame | None:
        prep = (preprocessor or Preprocessor()).fit(folded.where(F.col("fold") != f))
        encoded, delete_encoded = stage_for_now(
            prep.transform(folded).select(ID_COLUMN, "fold", label, "features"), "fold", partition_by="fold"
        )
        fitted = _fit_models(models, encoded.where(F.col("fold") != f), threads, failed)
        if not fitted:
            delete_encoded()
            return None
        part = F.when(F.col("fold") == f, "test").otherwise("train")
        rows = encoded if train_scores else encoded.where(F.col("fold") == f)
        rows = rows.withColumn("part", part).withColumn("fold", F.lit(f))
        scores = stage(score(rows, fitted, label), "scores")
        delete_encoded()  # only the scores are read from now on
        return scores

    parts = [p for p in run_parallel([lambda f=f: one_fold(f) for f in range(k)], fold_threads) if p is not None]
    delete_folds()
    if not parts:
        raise ValueError("no model could be fitted")
    return reduce(DataFrame.unionByName, parts).where(~F.col("model").isin(sorted(failed)))


def _fit_models(models, train, threads, failed) -> dict:
    def attempt(name, estimator):
        try:
            return estimator.fit(train)
        except MODEL_FAULTS as e:  # a lost executor or a full disk is none and ends the job
            log.error("cross-validation of %s failed: %s", name, e)
            failed.add(name)
            return None

    default_vote = {
        n: m for n, m in models.items()
        if isinstance(m, Classifier) and m.getOrDefault(m.kind) == "ensemble" and set(BASE_KINDS) <= set(models)
    }
    single = {n: m for n, m in models.items() if n not in default_vote}
    fitted = dict(zip(single, run_parallel([lambda n=n, m=m: attempt(n, m) for n, m in single.items()], threads)))
    for name, m in default_vote.items():
        bases = {b: fitted[b] for b in BASE_KINDS}
        if None in bases.values():
            failed.add(name)
        else:
            fitted[name] = vote_model(bases, m.options.get("voting", "hard"))
    return {n: m for n, m in fitted.items() if m is not None}


def fold_metrics(
    scored: DataFrame, keys: Sequence[str] = ("model", "fold"), scoring: str | Sequence[str] | None = None
) -> DataFrame:
    """The named metrics per model and fold; accuracy, precision, recall, f1 and roc_auc by default."""
    names = [scoring] if isinstance(scoring, str) else list(scoring or CV_METRICS)
    metrics = full_metrics(scored, keys).withColumnRenamed("auc", "roc_auc")
    unknown = [n for n in names if n not in metrics.columns]
    if unknown:
        raise ValueError(f"Unsupported metric: {unknown[0]}")
    return metrics.select(*keys, *names)


def cross_validate(
    models: Mapping[str, Estimator],
    df: DataFrame,
    k: int = CV_FOLDS,
    scoring: str | Sequence[str] | None = None,
    train_scores: bool = False,
    **options,
) -> DataFrame:
    """Metrics per model and fold; with ``train_scores`` also those of the training part."""
    scored = fold_scores(models, df, k, train_scores=train_scores, **options)
    return fold_metrics(scored, ("model", "fold", "part") if train_scores else ("model", "fold"), scoring)


def cv_summary(metrics: DataFrame, names: Sequence[str] = tuple(CV_METRICS)) -> DataFrame:
    """(Model, Metric, Mean, Std) over the folds, with the population deviation."""
    present = [n for n in names if n in metrics.columns]
    return (
        metrics.unpivot(["model"], present, "Metric", "value")
        .groupBy(F.col("model").alias("Model"), "Metric")
        .agg(F.avg("value").alias("Mean"), F.stddev_pop("value").alias("Std"))
    )
