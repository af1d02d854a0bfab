"""The registered queries: every operator over whole driver tables.

The evaluation operators run on the score table derived from the customer
table, so they need no training; the training operators run on the customer
table itself. Doubles are rounded at the very end, for comparison only.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import CATEGORICAL_FEATURES, ID_COLUMN, LABEL, NUMERICAL_FEATURES, SELECTED_FEATURES, TARGET, TENURE_BINS
from ..operators import boosting, clean as cl, curves, cv, eda, features as fe, inspect_models as im
from ..operators import metrics as me, prep, sampling as sa, thresholds as th, train as tr, tuning, voting
from ..operators.order_stats import exact_quantiles, long_values
from ..sources.profile import SCORERS, customer_profile, scored_profile
from ..sources.staging import new_path, stage
from ..sources.tables import read_raw, read_split, write_predictions, write_raw_csv, write_split
from . import jobs

Query = Callable[[SparkSession, str], DataFrame]
MODELS = list(SCORERS)
OPTIMAL = [f"{m}_optimal" for m in MODELS]


def rounded(df: DataFrame, digits: int = 6, but: Sequence[str] = ()) -> DataFrame:
    """Every double column rounded half up; the columns in ``but`` are left alone.

    Plain double operations, so that another engine can repeat them to the bit.
    """
    return df.selectExpr(*[
        _round(f.name, digits) if isinstance(f.dataType, T.DoubleType) and f.name not in but else f"`{f.name}`"
        for f in df.schema.fields
    ])


def _round(name: str, digits: int) -> str:
    scale = f"{10 ** digits}.0D"
    return f"floor(`{name}` * {scale} + 0.5D) / {scale} AS `{name}`"


def _ranked(df: DataFrame, *nine: str) -> DataFrame:
    """Round the named ranking metrics to nine digits, the rest to six."""
    return rounded(df, 6, but=nine).selectExpr(*[_round(c, 9) if c in nine else f"`{c}`" for c in df.columns])


# --- inputs -----------------------------------------------------------------
def cleaned(spark, d):
    return cl.clean(customer_profile(spark, d))


def written(spark, d, *columns):
    """The cleaned table, or some of its columns, written once for queries that read it several times."""
    table = cleaned(spark, d)
    return stage(table.select(*columns) if columns else table, "cleaned")


def split(spark, d, *columns):
    return sa.stratified_split(written(spark, d, *columns))


def lines_by_part(spark, d):
    """(id, part) of all order lines: a label with as many classes as there are parts."""
    line = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id")
    return stage(spark.read.parquet(f"{d}/lineitem.parquet").select(line, F.col("l_partkey").alias("part")), "lines")


def scored(spark, d):
    return scored_profile(customer_profile(spark, d))


def scored_written(spark, d):
    return scored_profile(written(spark, d, ID_COLUMN, "Contract", TARGET))


def fold_scored(spark, d):
    """Scored rows with their fold: the scores are a narrow function of the row, so no join."""
    table = written(spark, d, ID_COLUMN, "Contract", TARGET, LABEL)
    return scored_profile(sa.stratified_folds(table), ["fold"])


def vectors(spark, d, *keep):
    """Training rows of the customer table as encoded vectors, and the fitted preprocessing."""
    rows = split(spark, d).where(F.col("split") == "train")
    model = prep.Preprocessor().fit(rows)
    return stage(model.transform(rows).select(ID_COLUMN, LABEL, *keep, "features"), "vectors"), model


def train_test(spark, d):
    table = split(spark, d)
    model = prep.Preprocessor().fit(table.where(F.col("split") == "train"))
    encoded = stage(model.transform(table).select(ID_COLUMN, LABEL, "Contract", "split", "features"), "vectors")
    return encoded.where(F.col("split") == "train"), encoded.where(F.col("split") == "test").drop("split"), model


# --- sources and sinks --------------------------------------------------------
def read_raw_table(spark, d):
    path = write_raw_csv(customer_profile(spark, d), new_path(spark, "raw"))
    return read_raw(spark, path).withColumn(ID_COLUMN, F.col(ID_COLUMN).cast("long"))


def write_split_tables(spark, d):
    path = new_path(spark, "split")
    write_split(split(spark, d), path)
    return read_split(spark, path)


def read_split_table(spark, d):
    path = new_path(spark, "split")
    write_split(split(spark, d), path)
    return read_split(spark, path, "test").drop("split")


def prediction_table(spark, d):
    rows = scored_written(spark, d)
    optimal = th.with_optimal_predictions(rows, th.optimal_thresholds(rows))
    return th.prediction_table(rows.unionByName(optimal), MODELS + OPTIMAL)


def written_predictions(spark, d):
    table = prediction_table(spark, d)
    path = write_predictions(table, new_path(spark, "results"))
    return spark.read.option("header", True).schema(table.schema).csv(path)


def saved_and_loaded(spark, d):
    """Scores of a model before it was saved and after it was loaded."""
    train, test, _ = train_test(spark, d)
    model = tr.train_logistic_regression(train)
    again = tr.load_model(spark, tr.save_model(model, "lr_model", new_path(spark, "models")))
    return tr.score_wide(test, {"before": model, "after": again}).select(
        ID_COLUMN, "before_probability", "after_probability"
    )


# --- cleaning and features ------------------------------------------------------
def contract_dummies(spark, d):
    table = cleaned(spark, d)
    values = prep.Preprocessor(categorical=["Contract"], numerical=[]).fit(table).statistics["categorical"][0]["categories"]
    return fe.fixed_domain_dummies(table, "Contract", values, "Contract"), values


def contract_tenure(spark, d):
    table, values = contract_dummies(spark, d)
    return fe.add_contract_tenure(table).select(ID_COLUMN, *[f"Contract_{v}_tenure" for v in values])


def interaction_features(spark, d):
    table, values = contract_dummies(spark, d)
    out = fe.add_interactions(table)
    return rounded(out.select(ID_COLUMN, "tenure_to_monthly_ratio", *[f"Contract_{v}_tenure" for v in values]))


TENURE_DUMMIES = [f"tenure_group_{b[2]}" for b in TENURE_BINS]
COUNT_DUMMIES = [f"service_count_{x}" for x in ("None", "Basic", "Medium", "High", "Complete")]


def engineered(spark, d):
    return rounded(
        fe.engineer(cleaned(spark, d)).select(
            ID_COLUMN, "tenure_group", "service_count", "service_count_group", "tenure_to_monthly_ratio",
            *TENURE_DUMMIES, *COUNT_DUMMIES,
        )
    )


def segment_mapping(spark, d):
    columns = ["Contract", "PaymentMethod"]
    table = split(spark, d, ID_COLUMN, LABEL, *columns)
    fitted = prep.Preprocessor(categorical=columns, numerical=[]).fit(table.where(F.col("split") == "train"))
    return fe.segment_mapping(table.where(F.col("split") == "test"), columns, fitted.categories)


# --- fitted preprocessing ---------------------------------------------------------
def _train(table):
    return table.where(F.col("split") == "train")


def median_impute(spark, d):
    table = split(spark, d, ID_COLUMN, LABEL, *NUMERICAL_FEATURES)
    medians = exact_quantiles(long_values(_train(table), NUMERICAL_FEATURES), ["feature"], [0.5])
    by_name = {r["feature"]: r["q"][0] for r in medians.collect()}
    filled = table.select(
        ID_COLUMN, "split", *[F.coalesce(F.col(c).cast("double"), F.lit(by_name[c])).alias(c) for c in NUMERICAL_FEATURES]
    )
    return filled.unpivot([ID_COLUMN, "split"], NUMERICAL_FEATURES, "feature", "value")


def standard_scale(spark, d):
    return rounded(prep.numeric_statistics(_train(split(spark, d, ID_COLUMN, LABEL, *NUMERICAL_FEATURES)), NUMERICAL_FEATURES))


def mode_impute(spark, d):
    table = split(spark, d)
    modes = prep.mode_and_categories(prep.category_counts(_train(table), CATEGORICAL_FEATURES))
    by_name = {r["feature"]: r["mode"] for r in modes.collect()}
    filled = table.select(
        ID_COLUMN, "split", *[F.coalesce(F.col(c), F.lit(by_name[c])).alias(c) for c in CATEGORICAL_FEATURES]
    )
    return filled.unpivot([ID_COLUMN, "split"], CATEGORICAL_FEATURES, "feature", "value")


def _encoded_long(table, preprocessor):
    encoded, model = prep.fit_and_encode(table, (ID_COLUMN, "split"), preprocessor)
    names = ["`" + n.replace("`", "``") + "`" for n in model.feature_names]
    return encoded.unpivot([ID_COLUMN, "split"], [F.col(n) for n in names], "name", "value")


def one_hot(spark, d):
    return _encoded_long(split(spark, d), prep.Preprocessor(numerical=[]))


def one_hot_wide(spark, d):
    """Place of the one entry of every line's sparse vector over all parts, fitted on the training lines."""
    lines = stage(sa.stratified_split(lines_by_part(spark, d), id_column="id", label="part"), "lines")
    fitted = prep.Preprocessor(categorical=["part"], numerical=[], wideFrom=2).fit(_train(lines))
    vector = F.unwrap_udt("features")
    return fitted.transform(lines).select(
        "id", "split", vector["size"].alias("size"), F.get(vector["indices"], F.lit(0)).alias("place"),
        F.size(vector["indices"]).alias("entries"),
    )


def column_transformer(spark, d):
    return rounded(prep.fitted_statistics(prep.Preprocessor().fit(_train(split(spark, d))), spark))


def fit_and_encode(spark, d):
    return rounded(_encoded_long(split(spark, d), None))


def data_job(spark, d):
    """Per split, class and encoded column: rows and mean of the split tables the job wrote."""
    cfg = jobs.JobConfig(output_dir=new_path(spark, "job"))
    result = jobs.data_job(customer_profile(spark, d), cfg)
    table = read_split(spark, result.paths["train"].rsplit("/", 1)[0])
    names = result.preprocessor.feature_names
    long = table.unpivot(["split", LABEL], [F.col(f"`{n}`") for n in names], "name", "value")
    return rounded(
        long.groupBy("split", LABEL, "name").agg(F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean"))
    )


# --- training ---------------------------------------------------------------------
def trained(kind: str, params: dict | None = None) -> Query:
    def run(spark, d):
        train, test, _ = train_test(spark, d)
        return tr.score(test, {kind: tr.create_model(kind, params).fit(train)})
    return run


def soft_voting(spark, d):
    train, test, _ = train_test(spark, d)
    return tr.score(test, {"soft": tr.train_voting(train)})


def boosted(spark, d):
    train, test, _ = train_test(spark, d)
    return tr.score(test, {"boosted": boosting.train_boosted(train)})


def votes(spark, d):
    table = th.prediction_table(scored(spark, d), MODELS)
    return table.withColumnsRenamed({"CustomerID": ID_COLUMN, "True_Churn": "label"})


def hard_vote(spark, d):
    return votes(spark, d).select(
        ID_COLUMN, "label", voting.hard_vote([F.col(f"{m}_prediction") for m in MODELS]).alias("prediction")
    )


def soft_vote(spark, d):
    p = voting.soft_vote([F.col(f"{m}_probability") for m in MODELS])
    return rounded(votes(spark, d).select(ID_COLUMN, "label", p.alias("p"), voting.predict_soft(p).alias("prediction")))


def boosting_reweight(spark, d):
    rows = scored_written(spark, d)
    n = rows.agg(F.count(F.lit(1))).scalar()
    raised = boosting.reweight(rows.withColumn("weight", F.lit(1.0) / n))
    return rounded(raised.select(ID_COLUMN, "model", "label", "weight"), 12)


def all_models(spark, d):
    """Every model type trained and evaluated by the model job."""
    cfg = jobs.JobConfig(save_models=False, save_output=False)
    return jobs.model_job(jobs.data_job(customer_profile(spark, d), cfg), cfg).scored


def scored_invariants(spark, d):
    """What must hold for every test customer, whatever the four fitted models say."""
    p, said, vote = F.col("p"), F.col("prediction"), F.col("model") == "ensemble"
    return all_models(spark, d).groupBy(ID_COLUMN, "label").agg(
        F.count(F.lit(1)).alias("n_models"),
        F.bool_and(F.coalesce(p.between(0, 1), vote)).alias("in_range"),
        F.bool_and(F.coalesce(said == (p > 0.5).cast("int"), vote)).alias("consistent"),
        (F.max(F.when(vote, said)) == (F.sum(F.when(~vote, said)) >= 2).cast("int")).alias("majority"),
    )


def model_job(spark, d):
    cfg = jobs.JobConfig(save_output=False, output_dir=new_path(spark, "job"))
    return jobs.model_job(jobs.data_job(customer_profile(spark, d), cfg), cfg).segments


SATURATED = {
    "dt": {"max_depth": 8},
    "lr": {"penalty": None, "max_iter": 1000, "tol": 1e-12},
}


def dummies_of(spark, d, column: str):
    """All customers with the dummies of one category as vector, and the names of the dummies."""
    rows = written(spark, d, ID_COLUMN, column, LABEL)
    fitted = prep.Preprocessor(categorical=[column], numerical=[]).fit(rows)
    return stage(fitted.transform(rows).select(ID_COLUMN, LABEL, "features"), "vectors"), fitted.feature_names


def saturated(fit, digits: int) -> Query:
    """A model of one category's dummies can fit the class share of every value, and must."""
    def run(spark, d):
        table, _ = dummies_of(spark, d, "Contract")
        return rounded(tr.score(table, {"m": fit(spark, table)}).select(ID_COLUMN, "p"), digits)
    return run


def saturated_model(kind: str):
    return lambda spark, table: tr.create_model(kind, SATURATED[kind]).fit(table)


def saturated_vote(spark, table):
    return tr.train_voting(table, {k: tr.create_model(k, SATURATED[k]) for k in SATURATED}, "soft")


def saturated_boosting(spark, table):
    return boosting.train_boosted(table, rounds=1, max_depth=8)


def saturated_reload(spark, table):
    model = saturated_vote(spark, table)
    return tr.load_model(spark, tr.save_model(model, "vote", new_path(spark, "models")))


def saturated_coefficients(spark, d):
    table, names = dummies_of(spark, d, "Contract")
    model = tr.create_model("lr", SATURATED["lr"]).fit(table)
    return rounded(im.coefficient_table(spark, model, names), 3)


def stump_nodes(spark, d):
    """The three nodes of a tree that can only split on one dummy."""
    table, names = dummies_of(spark, d, "Partner")
    return rounded(im.tree_nodes(spark, tr.create_model("dt", {"max_depth": 1}).fit(table), names), 9)


def tuned(search) -> Query:
    """All grid points and folds of the search's defaults."""
    def run(spark, d):
        rows, _ = vectors(spark, d)
        return search(rows)[2]
    return run


# --- scoring and evaluation -------------------------------------------------------
def optimal_predictions(spark, d):
    rows = scored_written(spark, d)
    return th.with_optimal_predictions(rows, th.optimal_thresholds(rows))


def by_encoded_segment(spark, d):
    rows = scored_written(spark, d)
    fitted = prep.Preprocessor(categorical=["Contract"], numerical=[]).fit(rows)
    return _ranked(
        me.segment_metrics(rows, "Contract", baseline=fitted.categories["Contract"][0]), "auc", "average_precision"
    )


def best_over_scores(spark, d):
    metrics = ["f1", "precision", "recall", "balanced_accuracy"]
    return rounded(th.best_over_scores(scored_written(spark, d), metrics), but=["threshold"])


def cross_validated(spark, d):
    return cv.cross_validate({kind: tr.create_model(kind) for kind in tr.KINDS}, cleaned(spark, d))


def evaluation_job(spark, d):
    cfg = jobs.JobConfig(save_models=False, save_output=False)
    data = jobs.data_job(customer_profile(spark, d), cfg)
    return jobs.evaluation_job(data, jobs.model_job(data, cfg), cfg).predictions


# --- models from inside -------------------------------------------------------------
def importance(kind: str) -> Query:
    def run(spark, d):
        rows, model = vectors(spark, d)
        return im.feature_importance(spark, tr.create_model(kind).fit(rows), model.feature_names)
    return run


def coefficients(spark, d):
    rows, model = vectors(spark, d)
    return im.coefficient_table(spark, tr.train_logistic_regression(rows), model.feature_names)


def tree_importance(spark, d):
    rows, model = vectors(spark, d)
    return im.tree_importance(spark, tr.train_decision_tree(rows), model.feature_names)


def ensemble_importance(spark, d):
    rows, model = vectors(spark, d)
    return im.ensemble_importance(spark, tr.train_voting(rows), model.feature_names)


def tree_nodes(spark, d):
    rows, model = vectors(spark, d)
    return im.tree_nodes(spark, tr.train_decision_tree(rows), model.feature_names)


# --- jobs -----------------------------------------------------------------------------
def _row_counts(spark, tables, folder):
    paths = jobs.write_tables(tables, folder)
    counts = [
        spark.read.parquet(p).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name, p in paths.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _contents(spark, paths):
    """(table_name, row): every row of the written tables, as JSON with all columns."""
    tables = [
        spark.read.parquet(p).select(
            F.lit(name).alias("table_name"), F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row")
        )
        for name, p in paths.items()
    ]
    return reduce(DataFrame.unionByName, tables)


def eda_job(spark, d):
    """Rows per exploratory table that the job wrote."""
    table = written(spark, d)
    return _row_counts(spark, eda.eda_tables(table), new_path(spark, "eda"))


def eda_job_contents(spark, d):
    return _contents(spark, jobs.write_tables(eda.eda_tables(written(spark, d)), new_path(spark, "eda")))


def report_job(spark, d):
    """Rows per model table that the job wrote."""
    rows = scored_written(spark, d)
    summary = cv.cv_summary(cv.fold_metrics(fold_scored(spark, d)))
    return _row_counts(spark, jobs.report_tables(rows, me.model_metrics(rows), summary), new_path(spark, "report"))


def report_job_contents(spark, d):
    rows = scored_written(spark, d)
    summary = cv.cv_summary(cv.fold_metrics(fold_scored(spark, d)))
    tables = jobs.report_tables(rows, me.model_metrics(rows), summary)
    return _contents(spark, jobs.write_tables(tables, new_path(spark, "report")))


def whole_job(spark, d):
    """The whole job on the customer table; the contents of all tables that it wrote."""
    cfg = jobs.JobConfig(output_dir=new_path(spark, "job"))
    return _contents(spark, jobs.run_job(customer_profile(spark, d), cfg).table_paths)


def contract_report(spark, d):
    """Flagship: train logistic regression, score the test rows, metrics by contract."""
    train, test, _ = train_test(spark, d)
    rows = stage(tr.score(test, {"lr": tr.train_logistic_regression(train)}), "scores")
    return me.segment_metrics(rows, "Contract")


def queries() -> dict[str, Query]:
    six = lambda f: lambda s, d: rounded(f(s, d))
    return {
        "read_raw_table": read_raw_table,
        "write_split_tables": write_split_tables,
        "scored_invariants": scored_invariants,
        "saturated_tree": saturated(saturated_model("dt"), 9),
        "saturated_regression": saturated(saturated_model("lr"), 4),
        "saturated_soft_vote": saturated(saturated_vote, 4),
        "saturated_reload": saturated(saturated_reload, 4),
        "saturated_boosting": saturated(saturated_boosting, 9),
        "saturated_coefficients": saturated_coefficients,
        "stump_nodes": stump_nodes,
        "read_split_table": read_split_table,
        "write_predictions": written_predictions,
        "save_and_load_model": saved_and_loaded,
        "clean_table": cleaned,
        "charges_to_number": lambda s, d: cl.charges_to_number(customer_profile(s, d)).select(ID_COLUMN, "TotalCharges"),
        "fill_missing_charges": lambda s, d: cl.fill_missing_charges(
            cl.charges_to_number(customer_profile(s, d))).select(ID_COLUMN, "TotalCharges"),
        "senior_to_text": lambda s, d: cl.senior_to_text(customer_profile(s, d)).select(ID_COLUMN, "SeniorCitizen"),
        "binary_label": lambda s, d: cl.add_binary_label(customer_profile(s, d)).select(ID_COLUMN, "Churn", LABEL),
        "drop_non_features": lambda s, d: cl.drop_non_features(cleaned(s, d)),
        "select_features": lambda s, d: cl.select_existing(cleaned(s, d), SELECTED_FEATURES),
        "stratified_split": lambda s, d: split(s, d, ID_COLUMN, LABEL),
        "stratified_folds": lambda s, d: sa.stratified_folds(written(s, d, ID_COLUMN, LABEL)),
        "split_by_many_classes": lambda s, d: sa.stratified_split(lines_by_part(s, d), id_column="id", label="part"),
        "folds_by_many_classes": lambda s, d: sa.stratified_folds(lines_by_part(s, d), id_column="id", label="part"),
        "append_rows": lambda s, d: (lambda t: sa.append_rows(
            t.where(F.col("split") == "train").drop("split"), t.where(F.col("split") == "test").drop("split")
        ))(split(s, d, ID_COLUMN, "tenure", LABEL)),
        "segment_rows": lambda s, d: sa.segment_rows(scored(s, d), "Contract", "BUILDING").select(
            ID_COLUMN, "model", "label", "p"),
        "tenure_groups": lambda s, d: fe.add_tenure_groups(cleaned(s, d)).select(
            ID_COLUMN, "tenure", "tenure_group", "tenure_group_ordinal"),
        "fixed_domain_dummies": lambda s, d: fe.add_tenure_groups(cleaned(s, d)).select(ID_COLUMN, *TENURE_DUMMIES),
        "service_count": lambda s, d: fe.add_service_count(cleaned(s, d)).select(ID_COLUMN, "service_count"),
        "service_count_groups": lambda s, d: fe.add_service_count(cleaned(s, d)).select(
            ID_COLUMN, "service_count_group", "service_count_group_ordinal", *COUNT_DUMMIES),
        "charge_ratio": six(lambda s, d: fe.add_charge_ratio(cleaned(s, d)).select(ID_COLUMN, "tenure_to_monthly_ratio")),
        "contract_tenure": contract_tenure,
        "interaction_features": interaction_features,
        "engineer_features": engineered,
        "segment_mapping": segment_mapping,
        "median_impute": median_impute,
        "standard_scale": standard_scale,
        "mode_impute": mode_impute,
        "one_hot": one_hot,
        "one_hot_wide": one_hot_wide,
        "column_transformer": column_transformer,
        "fit_and_encode": fit_and_encode,
        "data_job": data_job,
        "class_weights": six(lambda s, d: tr.class_weight_table(cleaned(s, d))),
        "train_logistic_regression": trained("lr"),
        "train_decision_tree": trained("dt"),
        "train_random_forest": trained("rf"),
        "train_hard_voting": trained("ensemble"),
        "train_soft_voting": soft_voting,
        "train_boosted": boosted,
        "model_factory": trained("dt", {"max_depth": 3}),
        "train_and_score_all": all_models,
        "model_job": model_job,
        "tune_logistic_regression": tuned(tuning.tune_logistic_regression),
        "tune_decision_tree": tuned(tuning.tune_decision_tree),
        "tune_random_forest": tuned(tuning.tune_random_forest),
        "hard_vote": hard_vote,
        "soft_vote": soft_vote,
        "boosting_reweight": boosting_reweight,
        "threshold_predictions": lambda s, d: scored(s, d).select(
            ID_COLUMN, "model", th.predict_at(F.col("p"), F.lit(0.35)).alias("prediction")),
        "optimal_predictions": optimal_predictions,
        "prediction_table": prediction_table,
        "full_metrics": lambda s, d: _ranked(me.full_metrics(scored_written(s, d)), "auc", "average_precision"),
        "model_metrics": lambda s, d: _ranked(me.model_metrics(scored_written(s, d)), "auc"),
        "confusion_matrix": lambda s, d: me.confusion_counts(scored(s, d), ["model"]),
        "classification_report": six(lambda s, d: me.classification_report(scored(s, d))),
        "metrics_by_segment": lambda s, d: _ranked(
            me.segment_metrics(scored_written(s, d), "Contract"), "auc", "average_precision"),
        "metrics_by_encoded_segment": by_encoded_segment,
        "roc_auc": lambda s, d: rounded(curves.ranking_metrics(scored_written(s, d), ["model"]).select("model", "auc"), 9),
        # The paths for many rows, on ranges and groups small enough to be entered here.
        "roc_auc_in_ranges": lambda s, d: rounded(
            curves.ranking_metrics(scored_written(s, d), ["model"], rows_per_range=50).select("model", "auc"), 9),
        "box_statistics_in_rounds": six(
            lambda s, d: eda.box_statistics(written(s, d, *NUMERICAL_FEATURES, TARGET), small_group=100)),
        "average_precision": lambda s, d: rounded(
            curves.ranking_metrics(scored_written(s, d), ["model"]).select("model", "average_precision"), 9),
        "roc_curve": lambda s, d: rounded(curves.roc_curve(scored_written(s, d), ["model"]), 9, but=["threshold"]),
        "pr_curve": lambda s, d: rounded(curves.pr_curve(scored_written(s, d), ["model"]), 9, but=["threshold"]),
        "pr_summary": lambda s, d: rounded(curves.pr_summary(scored_written(s, d), ["model"]), 9),
        "model_comparison": six(lambda s, d: me.comparison_table(me.model_metrics(scored_written(s, d)))),
        "cross_validate": cross_validated,
        "fold_metrics": six(lambda s, d: cv.fold_metrics(fold_scored(s, d))),
        "cv_summary": six(lambda s, d: cv.cv_summary(cv.fold_metrics(fold_scored(s, d)))),
        "evaluation_job": evaluation_job,
        "threshold_sweep": lambda s, d: rounded(th.threshold_sweep(scored(s, d)), but=["threshold"]),
        "best_threshold_on_grid": lambda s, d: rounded(
            th.best_on_grid(th.threshold_sweep(scored(s, d))), but=["threshold"]),
        "optimal_thresholds": lambda s, d: rounded(th.optimal_thresholds(scored(s, d)), but=["threshold"]),
        "best_threshold_over_scores": best_over_scores,
        "optimal_thresholds_by_segment": lambda s, d: rounded(
            th.optimal_thresholds(scored(s, d), ["model", "Contract"]), but=["threshold"]),
        "confusion_at_thresholds": lambda s, d: rounded(th.matrices_at(scored(s, d)), but=["threshold"]),
        "threshold_sweep_long": lambda s, d: rounded(
            th.sweep_long(th.threshold_sweep(scored(s, d))), but=["threshold"]),
        "feature_importance": importance("ensemble"),
        "logistic_coefficients": coefficients,
        "tree_importance": tree_importance,
        "ensemble_importance": ensemble_importance,
        "tree_nodes": tree_nodes,
        "target_distribution": lambda s, d: eda.target_distribution(written(s, d, TARGET)),
        "category_by_target": six(lambda s, d: eda.category_by_target(cleaned(s, d))),
        "box_statistics": six(lambda s, d: eda.box_statistics(written(s, d, *NUMERICAL_FEATURES, TARGET))),
        "box_outliers": six(lambda s, d: eda.box_outliers(written(s, d, *NUMERICAL_FEATURES, TARGET))),
        "density": lambda s, d: _ranked(eda.density(written(s, d, *NUMERICAL_FEATURES, TARGET)), "density"),
        "correlation_matrix": six(lambda s, d: eda.correlation_matrix(written(s, d))),
        "tenure_histogram": six(lambda s, d: eda.tenure_histogram(written(s, d, "tenure", TARGET))),
        "churn_by_tenure": six(lambda s, d: eda.churn_by_tenure(cleaned(s, d))),
        "churn_by_service": six(lambda s, d: eda.churn_by_service(cleaned(s, d))),
        "churn_by_service_long": six(lambda s, d: eda.service_long(eda.churn_by_service(cleaned(s, d)))),
        "eda_job": eda_job,
        "report_job": report_job,
        "eda_job_contents": eda_job_contents,
        "report_job_contents": report_job_contents,
        "whole_job": whole_job,
        "contract_report": contract_report,
    }
