"""Training and scoring with Spark ML.

A classifier here is an Estimator that looks up the class weights and the
weight total before it hands over to Spark ML, so its parameters mean the same
objective whatever the number of rows.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import InheritableThread, keyword_only
from pyspark.ml import Estimator, Model, PipelineModel, Transformer
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DT_PARAMS, LABEL, LR_PARAMS, RF_PARAMS, SEED
from .nested import smallest_split, without_small_splits
from .sampling import class_counts
from .voting import HardVote, ShareScore, SoftVote, hard_vote, predict_soft, soft_vote

BASE_KINDS = ("lr", "dt", "rf")
KINDS = (*BASE_KINDS, "ensemble")
DEFAULTS = {"lr": LR_PARAMS, "dt": DT_PARAMS, "rf": RF_PARAMS, "ensemble": {"voting": "hard"}}
DEEPEST = 30  # the deepest tree Spark ML grows
MAX_BINS = 128
SHALLOW = 10  # beyond this depth every row's nodes are kept, not found by sending the grown trees to all tasks at every level
# Parameter names each kind takes; any other name is refused. Without effect here: the solver, random_state of the
# logistic regression and n_jobs.
_TREE_NAMES = {"max_depth", "min_samples_leaf", "min_samples_split", "criterion", "class_weight", "random_state", "max_bins"}
PARAMETERS = {
    "lr": {"C", "penalty", "l1_ratio", "max_iter", "tol", "class_weight", "solver", "random_state"},
    "dt": _TREE_NAMES,
    "rf": _TREE_NAMES | {"n_estimators", "max_features", "n_jobs"},
    "ensemble": {"voting"},
}


def class_weight_table(df: DataFrame, label: str = LABEL) -> DataFrame:
    """(label, n, weight): balanced weights n_total / (classes * n)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    classes = counts.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("weight", total.cast("double") / (classes * F.col("n")).cast("double"))


def balanced_weights(counts: Mapping[int, int]) -> dict[int, float]:
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items()}


def class_weight_column(weights: Mapping[int, float], label: str):
    w = F.lit(1.0)
    for c, value in weights.items():
        w = F.when(F.col(label) == c, F.lit(value)).otherwise(w)
    return w


class Classifier(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """One of lr, dt, rf, ensemble. ``settings`` is the parameter set as JSON."""

    kind = Param(Params._dummy(), "kind", "lr, dt, rf or ensemble", TypeConverters.toString)
    settings = Param(Params._dummy(), "settings", "parameters as JSON", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 column", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, kind="lr", settings="{}", featuresCol="features", labelCol=LABEL):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(kind="lr", settings="{}", featuresCol="features", labelCol=LABEL)

    @property
    def options(self) -> dict:
        return json.loads(self.getOrDefault(self.settings))

    def _fit(self, dataset: DataFrame) -> Transformer:
        kind, label = self.getOrDefault(self.kind), self.getOrDefault(self.labelCol)
        features = self.getOrDefault(self.featuresCol)
        if kind == "ensemble":
            bases = fit_all({k: create_model(k, label=label, features=features) for k in BASE_KINDS}, dataset)
            return vote_model(bases, self.options.get("voting", "hard"))
        counts = class_counts(dataset, label)
        return fit_base(dataset, kind, self.options, counts, label, features)


def fit_base(dataset, kind, options, counts, label=LABEL, features="features") -> Model:
    """Fit one of lr, dt, rf. ``counts`` holds the training rows per class."""
    given = options.get("class_weight")
    if given == "balanced":
        weights = balanced_weights(counts)
    elif given is None:
        weights = {}
    else:  # a map; JSON turns its keys into text
        weights = {int(c): float(w) for c, w in given.items()}
    weighted = dataset.where(F.col(label).isNotNull()).select(
        F.col(features), F.col(label).cast("double").alias(label),
        class_weight_column(weights, label).alias("class_weight"),
    )
    common = {"featuresCol": features, "labelCol": label, "weightCol": "class_weight"}
    if kind == "lr":
        total = sum(n * weights.get(c, 1.0) for c, n in counts.items())
        penalty = options.get("penalty", "l2")
        return LogisticRegression(
            maxIter=int(options.get("max_iter", 1000)),
            # The penalty is per row in Spark ML; C scales the sum over all rows.
            regParam=0.0 if penalty is None else 1.0 / (float(options.get("C", 1.0)) * total),
            elasticNetParam={"l1": 1.0, "elasticnet": float(options.get("l1_ratio") or 0.0)}.get(penalty, 0.0),
            tol=float(options.get("tol", 1e-6)),
            standardization=False,
            **common,
        ).fit(weighted)
    if kind not in ("dt", "rf"):
        raise ValueError(f"Unsupported model type: {kind}")
    depth = options.get("max_depth")
    tree = {
        "maxDepth": DEEPEST if depth is None else int(depth),
        "minInstancesPerNode": int(options.get("min_samples_leaf", 1)),
        "maxBins": int(options.get("max_bins", MAX_BINS)),
        "seed": int(options.get("random_state", SEED)),
        "cacheNodeIds": depth is None or int(depth) > SHALLOW,
        **common,
    }
    forest = {}
    if kind == "rf":
        subset = options.get("max_features", "sqrt")
        forest = {"numTrees": int(options.get("n_estimators", 100)), "featureSubsetStrategy": "all" if subset is None else str(subset)}
    smallest = smallest_split(options.get("min_samples_split"), sum(counts.values()))
    criterion = options.get("criterion", "gini")
    if criterion == "gini":
        # The variance of a 0/1 label is half its gini impurity, so splits are the same, and a leaf's mean is its class
        # share. A classifier would merge sister leaves of one majority and lose their shares.
        learner = DecisionTreeRegressor if kind == "dt" else RandomForestRegressor
        return share_model(without_small_splits(learner(impurity="variance", **forest, **tree).fit(weighted), smallest))
    learner = DecisionTreeClassifier if kind == "dt" else RandomForestClassifier
    return without_small_splits(learner(impurity=criterion, **forest, **tree).fit(weighted), smallest)


def share_model(tree: Model) -> PipelineModel:
    """A fitted regression tree or forest on a 0/1 label as a classifier."""
    tree.setPredictionCol("share")
    return PipelineModel([tree, ShareScore()])


def is_share_model(model: Transformer) -> bool:
    return isinstance(model, PipelineModel) and len(model.stages) == 2 and isinstance(model.stages[1], ShareScore)


def create_model(kind: str, params: dict | None = None, label: str = LABEL, features: str = "features") -> Classifier:
    """Given parameters replace the defaults as a whole."""
    if kind not in KINDS:
        raise ValueError(f"Unsupported model type: {kind}")
    options = DEFAULTS[kind] if params is None else params
    unknown = sorted(set(options) - PARAMETERS[kind])
    if unknown:
        raise ValueError(f"{kind} has no parameter {', '.join(unknown)}")
    if kind == "lr" and options.get("penalty", "l2") not in (None, "l1", "l2", "elasticnet"):
        raise ValueError(f"Unsupported penalty: {options['penalty']}")
    return Classifier(kind=kind, settings=json.dumps(options), featuresCol=features, labelCol=label)


def train_model(model: Estimator, df: DataFrame) -> Transformer:
    return model.fit(df)


def train_logistic_regression(df: DataFrame, params: dict | None = None, **columns) -> Transformer:
    return create_model("lr", params, **columns).fit(df)


def train_decision_tree(df: DataFrame, params: dict | None = None, **columns) -> Transformer:
    return create_model("dt", params, **columns).fit(df)


def train_random_forest(df: DataFrame, params: dict | None = None, **columns) -> Transformer:
    return create_model("rf", params, **columns).fit(df)


def train_voting(
    df: DataFrame, models: Mapping[str, Estimator] | None = None, voting: str = "soft", **columns
) -> PipelineModel:
    """Fit every base model once and combine them."""
    bases = models or {k: create_model(k, **columns) for k in BASE_KINDS}
    return vote_model(fit_all(bases, df), voting)


def fit_all(models: Mapping[str, Estimator], df: DataFrame, threads: int = 3) -> dict[str, Transformer]:
    """Fit independent models side by side; each fit is a distributed job of its own."""
    return dict(zip(models, run_parallel([lambda e=e: e.fit(df) for e in models.values()], threads)))


def run_parallel(tasks: Sequence, threads: int) -> list:
    """Results of the tasks in order. Every thread carries the session's local properties."""
    def call(task):
        out = {}

        def body():
            try:
                out["value"] = task()
            except BaseException as e:  # handed to the caller below
                out["error"] = e

        t = InheritableThread(target=body)
        t.start()
        t.join()
        if "error" in out:
            raise out["error"]
        return out["value"]

    with ThreadPoolExecutor(max(1, min(threads, len(tasks) or 1))) as pool:
        return list(pool.map(call, tasks))


def member_stages(model: Transformer, probability: str, prediction: str) -> list[Transformer]:
    """Stages that write a fitted model's scores to the named columns and nothing else."""
    if is_share_model(model):
        tree = model.stages[0].copy()
        tree.setPredictionCol(f"{probability}_share")
        return [tree, ShareScore(share=f"{probability}_share", probabilityCol=probability, predictionCol=prediction)]
    member = model.copy()
    member.setRawPredictionCol("")
    member.setProbabilityCol(probability)
    member.setPredictionCol(prediction)
    return [member]


def vote_model(bases: Mapping[str, Transformer], voting: str) -> PipelineModel:
    """The fitted base models and a vote as one saveable model."""
    stages = []
    for name, model in bases.items():
        stages += member_stages(model, f"{name}_probability", f"{name}_prediction")
    vote = SoftVote if voting == "soft" else HardVote
    return PipelineModel([*stages, vote(names=list(bases))])


def vote_members(model: Transformer) -> list[str]:
    """Names of the base models of a vote, empty for another model."""
    if isinstance(model, PipelineModel) and isinstance(model.stages[-1], (HardVote, SoftVote)):
        return list(model.stages[-1].getOrDefault("names"))
    return []


def has_probability(model: Transformer) -> bool:
    return not (isinstance(model, PipelineModel) and isinstance(model.stages[-1], HardVote))


def score_wide(df: DataFrame, models: Mapping[str, Transformer], features: str = "features") -> DataFrame:
    """Add ``{model}_prediction`` and ``{model}_probability``; drops the vector.

    All models run on a row in one pass. A vote whose members are scored in the
    same call reads their columns instead of running them again.
    """
    kept = df.columns
    votes = {n: m for n, m in models.items() if vote_members(m) and set(vote_members(m)) <= set(models)}
    for name, model in models.items():
        if name in votes:
            continue
        p = vector_to_array("probability")[1] if has_probability(model) else F.lit(None).cast("double")
        scored = model.transform(df.select(*kept))
        df = scored.select(
            *kept, F.col("prediction").cast("int").alias(f"{name}_prediction"), p.alias(f"{name}_probability")
        )
        kept = df.columns
    for name, model in votes.items():
        members = vote_members(model)
        if has_probability(model):
            p = soft_vote([F.col(f"{m}_probability") for m in members])
            prediction = predict_soft(p)
        else:
            p = F.lit(None).cast("double")
            prediction = hard_vote([F.col(f"{m}_prediction") for m in members])
        df = df.withColumns({f"{name}_prediction": prediction, f"{name}_probability": p})
    return df.drop(features)


def to_long(wide: DataFrame, names: Sequence[str], label: str = LABEL) -> DataFrame:
    """One row per customer and model: (…, model, label, p, prediction). Narrow."""
    score_columns = {f"{n}_{k}" for n in names for k in ("prediction", "probability")}
    kept = [c for c in wide.columns if c not in score_columns and c != label]
    scores = F.array(*[
        F.struct(
            F.lit(n).alias("model"),
            F.col(f"{n}_probability").alias("p"),
            F.col(f"{n}_prediction").alias("prediction"),
        )
        for n in names
    ])
    return wide.select(*kept, F.col(label).cast("int").alias("label"), F.explode(scores).alias("s")).select(
        *kept, "s.model", "label", "s.p", "s.prediction"
    )


def score(df: DataFrame, models: Mapping[str, Transformer], label: str = LABEL, features: str = "features") -> DataFrame:
    return to_long(score_wide(df, models, features), list(models), label)


def save_model(model: MLWritable, name: str, folder: str) -> str:
    path = f"{folder.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> Transformer:
    """Load whatever kind of model was saved at ``path``."""
    meta = json.loads(spark.read.text(f"{path.rstrip('/')}/metadata").first()[0])
    name = meta["class"]
    if name.startswith("org.apache.spark.ml."):
        from pyspark.ml.pipeline import PipelineModelReader
        from pyspark.ml.util import DefaultParamsReader

        if name.endswith(".PipelineModel"):
            return PipelineModelReader(PipelineModel).load(path)
        return DefaultParamsReader.loadParamsInstance(path, spark)
    if name.endswith(".PipelineModel"):
        return PipelineModel.load(path)
    module, _, cls = name.rpartition(".")
    return getattr(__import__(module, fromlist=[cls]), cls).load(path)
