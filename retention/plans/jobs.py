"""Whole jobs: plain function composition over lazy tables.

Expensive tables are written once to the shared folder where several actions
read them; only fitted statistics and metric tables reach the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml import Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    CATEGORICAL_FEATURES, CV_FOLDS, ID_COLUMN, LABEL, NUMERICAL_FEATURES, SEED, TEST_SIZE, THRESHOLD_METRICS,
)
from ..operators.clean import clean
from ..operators.curves import pr_curve, pr_summary, roc_curve
from ..operators.cv import cross_validate, cv_summary, fold_scores
from ..operators.eda import eda_tables
from ..operators.features import engineer, segment_mapping
from ..operators.inspect_models import feature_importance
from ..operators.metrics import comparison_table, model_metrics, segment_metrics
from ..operators.prep import Preprocessor, PreprocessorModel
from ..operators.row_index import with_row_index
from ..operators.sampling import stratified_split
from ..operators.thresholds import (
    best_on_grid, matrices_at, optimal_thresholds, predict_at, sweep_long, threshold_sweep,
)
from ..operators.train import (
    KINDS, create_model, fit_all, has_probability, run_parallel, save_model, score_wide, to_long, vote_model,
)
from ..sources.staging import stage
from ..sources.tables import write_predictions, write_split

ENGINEERED_NUMERIC = ["service_count", "tenure_to_monthly_ratio"]
ENGINEERED_CATEGORICAL = ["tenure_group", "service_count_group"]
WRITERS = 4  # result tables written at a time


@dataclass
class JobConfig:
    output_dir: str | None = None  # where models, splits, predictions and tables are saved
    models: Sequence[str] = KINDS
    test_size: float = TEST_SIZE
    seed: int = SEED
    cv_folds: int = CV_FOLDS
    run_eda: bool = True
    run_cv: bool = True
    run_thresholds: bool = True
    save_models: bool = True
    save_output: bool = True
    use_engineered: bool = False
    segment_columns: Sequence[str] = ("Contract",)
    include_baseline: bool = True
    threshold_metrics: Sequence[str] = tuple(THRESHOLD_METRICS)
    tune_on: str = "test"  # or "validation": thresholds from held-out folds of the training rows
    model_params: Mapping[str, dict] = field(default_factory=dict)


@dataclass
class DataResult:
    cleaned: DataFrame
    split: DataFrame
    vectors: DataFrame
    preprocessor: PreprocessorModel
    segment_map: DataFrame
    paths: dict[str, str]


@dataclass
class ModelResult:
    models: dict[str, Transformer]
    wide: DataFrame
    scored: DataFrame
    metrics: DataFrame
    segments: DataFrame
    importances: dict[str, DataFrame]
    paths: dict[str, str]


@dataclass
class EvaluationResult:
    cv: DataFrame | None
    cv_summary: DataFrame | None
    sweep: DataFrame | None
    thresholds: DataFrame | None
    predictions: DataFrame
    predictions_path: str | None


def make_preprocessor(cfg: JobConfig) -> Preprocessor:
    if not cfg.use_engineered:
        return Preprocessor()
    return Preprocessor(
        numerical=NUMERICAL_FEATURES + ENGINEERED_NUMERIC,
        categorical=CATEGORICAL_FEATURES + ENGINEERED_CATEGORICAL,
    )


def data_job(raw: DataFrame, cfg: JobConfig) -> DataResult:
    """Clean, derive, split, fit the preprocessing on the training rows, encode, save."""
    prepared = clean(raw)
    if cfg.use_engineered:
        prepared = engineer(prepared)
    cleaned = stage(prepared, "cleaned")
    split = stratified_split(cleaned, cfg.test_size, cfg.seed)
    prep = make_preprocessor(cfg).fit(split.where(F.col("split") == "train"))
    vectors = stage(prep.transform(split), "vectors")
    paths = {}
    if cfg.save_output and cfg.output_dir:
        paths = write_split(prep.encode(split, [ID_COLUMN, LABEL, "split"]), f"{cfg.output_dir}/processed")
    test = split.where(F.col("split") == "test")
    return DataResult(
        cleaned, split, vectors, prep, segment_mapping(test, cfg.segment_columns, prep.categories), paths
    )


def model_job(data: DataResult, cfg: JobConfig) -> ModelResult:
    """Train every model, score the test rows once, metrics by model and by segment."""
    spark = data.vectors.sparkSession
    train = data.vectors.where(F.col("split") == "train")
    estimators = {k: create_model(k, cfg.model_params.get(k)) for k in cfg.models if k != "ensemble"}
    votes_on = ("lr", "dt", "rf")
    reuse = "ensemble" in cfg.models and set(votes_on) <= set(estimators) and not cfg.model_params
    if "ensemble" in cfg.models and not reuse:
        estimators["ensemble"] = create_model("ensemble", cfg.model_params.get("ensemble"))
    models = fit_all(estimators, train)
    if reuse:  # the same default members, so they are not fitted a second time
        models["ensemble"] = vote_model({k: models[k] for k in votes_on}, "hard")
    models = {k: models[k] for k in cfg.models}

    paths = {}
    if cfg.save_models and cfg.output_dir:
        paths = {k: save_model(m, f"{k}_model", f"{cfg.output_dir}/models") for k, m in models.items()}
    kept = list(dict.fromkeys([ID_COLUMN, LABEL, *cfg.segment_columns]))
    test = data.vectors.where(F.col("split") == "test").select(*kept, "features")
    wide = stage(score_wide(test, models), "scores")
    scored = to_long(wide, list(models))
    segments = None
    for column in cfg.segment_columns:
        fitted = data.preprocessor.categories.get(column, [])
        baseline = None if cfg.include_baseline or not fitted else fitted[0]
        part = segment_metrics(scored, column, baseline=baseline).withColumn("column", F.lit(column))
        segments = part if segments is None else segments.unionByName(part)
    names = data.preprocessor.feature_names
    importances = {k: feature_importance(spark, m, names) for k, m in models.items()}
    return ModelResult(models, wide, scored, model_metrics(scored), segments, importances, paths)


def prediction_columns(wide: DataFrame, models: Mapping[str, Transformer], cuts: Mapping[str, float]) -> DataFrame:
    """The prediction table straight from the wide scores: narrow, one row per customer.

    Without the id column the rows get an ``Index`` instead.
    """
    columns = [F.col(LABEL).cast("int").alias("True_Churn")]
    for m, model in models.items():
        columns.append(F.col(f"{m}_prediction"))
        if has_probability(model):
            columns.append(F.col(f"{m}_probability"))
    for m, cut in cuts.items():
        columns += [
            predict_at(F.col(f"{m}_probability"), F.lit(cut)).alias(f"{m}_optimal_prediction"),
            F.col(f"{m}_probability").alias(f"{m}_optimal_probability"),
        ]
    if ID_COLUMN in wide.columns:
        return wide.select(F.col(ID_COLUMN).alias("CustomerID"), *columns)
    table = wide.select(*columns).withColumn("row", F.monotonically_increasing_id())
    return with_row_index(table, ["row"], "Index").drop("row")


def evaluation_job(data: DataResult, model: ModelResult, cfg: JobConfig) -> EvaluationResult:
    """Cross-validation, threshold search and the prediction table, each switchable."""
    cv = summary = sweep = best = None
    if cfg.run_cv:
        estimators = {k: create_model(k, cfg.model_params.get(k)) for k in cfg.models}
        cv = cross_validate(estimators, data.cleaned, cfg.cv_folds, preprocessor=make_preprocessor(cfg), seed=cfg.seed)
        summary = cv_summary(cv)
    cuts: dict[str, float] = {}
    if cfg.run_thresholds:
        sweep = threshold_sweep(model.scored)
        if cfg.tune_on == "validation":
            estimators = {k: create_model(k, cfg.model_params.get(k)) for k in cfg.models}
            rows = fold_scores(
                estimators, data.split.where(F.col("split") == "train").drop("split"), cfg.cv_folds,
                preprocessor=make_preprocessor(cfg), seed=cfg.seed,
            )
            best = optimal_thresholds(rows, metrics=cfg.threshold_metrics)
        else:
            best = best_on_grid(sweep, metrics=cfg.threshold_metrics)
        # One row per model.
        cuts = {r["model"]: r["threshold"] for r in best.where(F.col("metric") == "f1").collect()}
    predictions = prediction_columns(model.wide, model.models, cuts)
    path = None
    if cfg.output_dir:
        path = write_predictions(predictions, f"{cfg.output_dir}/results")
    return EvaluationResult(cv, summary, sweep, best, predictions, path)


def report_tables(scored: DataFrame, metrics: DataFrame, summary: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables behind the model charts."""
    sweep = threshold_sweep(scored)
    tables = {
        "roc_curve": roc_curve(scored, ["model"]),
        "pr_curve": pr_curve(scored, ["model"]),
        "pr_summary": pr_summary(scored, ["model"]),
        "threshold_sweep": sweep_long(sweep),
        "optimal_thresholds": best_on_grid(sweep),
        "confusion_at_thresholds": matrices_at(scored),
        "model_comparison": comparison_table(metrics),
    }
    if summary is not None:
        tables["cross_validation"] = summary
    return tables


def write_tables(tables: Mapping[str, DataFrame], folder: str) -> dict[str, str]:
    """Write small result tables, one folder each, several at a time: each one alone leaves most cores idle."""
    paths = {name: f"{folder.rstrip('/')}/{name}" for name in tables}
    run_parallel([lambda n=n: tables[n].write.mode("overwrite").parquet(paths[n]) for n in tables], WRITERS)
    return paths


@dataclass
class JobResult:
    data: DataResult
    model: ModelResult
    evaluation: EvaluationResult
    eda: dict[str, DataFrame]
    report: dict[str, DataFrame]
    table_paths: dict[str, str]


def run_job(raw: DataFrame, cfg: JobConfig | None = None) -> JobResult:
    """Data, models, evaluation and report of one raw customer table."""
    cfg = cfg or JobConfig()
    if "all" in cfg.models:
        cfg = replace(cfg, models=KINDS)
    unknown = set(cfg.models) - set(KINDS)
    if unknown:
        raise ValueError(f"Unsupported model type: {sorted(unknown)[0]}")
    data = data_job(raw, cfg)
    model = model_job(data, cfg)
    # Neither needs the other, and the fits of the folds do not fill all cores.
    evaluation, eda = run_parallel(
        [lambda: evaluation_job(data, model, cfg), lambda: eda_tables(data.cleaned) if cfg.run_eda else {}], 2
    )
    report = report_tables(model.scored, model.metrics, evaluation.cv_summary)
    paths = {}
    if cfg.output_dir:
        paths = {
            **write_tables(eda, f"{cfg.output_dir}/tables/eda"),
            **write_tables(report, f"{cfg.output_dir}/tables/models"),
            **write_tables(
                {"model_metrics": model.metrics, "segment_metrics": model.segments}, f"{cfg.output_dir}/tables/models"
            ),
        }
    return JobResult(data, model, evaluation, eda, report, paths)
