"""Fitted preprocessing: exact median and mode imputing, population scaling, one-hot.

Fitting takes three jobs that shuffle only aggregates: moments of the numeric
columns, exact medians, and category counts of all text columns. The fitted
model is one narrow projection, so scoring 100 TB adds no shuffle.

A text column of many categories is wide: its categories stay a table (value,
code), numbered over range partitions and saved with the model. Its rows get
their code by a join, and a sparse vector instead of a column per category.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CATEGORICAL_FEATURES, NUMERICAL_FEATURES
from ..sources.staging import broadcast_if_small, new_path, stage
from .order_stats import SMALL_GROUP, exact_quantiles, long_values
from .row_index import with_row_index

WIDE_FROM = 1_000


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, value, n) of the non-null values of all text columns, in one shuffle."""
    return (
        df.select(*[F.col(c).cast("string").alias(c) for c in columns])
        .unpivot([], list(columns), "feature", "value")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def numeric_statistics(df: DataFrame, columns: Sequence[str], small_group: int = SMALL_GROUP) -> DataFrame:
    """(feature, median, mean, std): exact median, then moments after imputing with it.

    The imputed moments follow in closed form from the non-null ones, so the
    data is not scanned again after the median is known. A column without any
    value is left out.
    """
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None)) for c in columns}
    moments = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(values.values())],
        *[F.avg(v).alias(f"mean{i}") for i, v in enumerate(values.values())],
        *[F.var_pop(v).alias(f"var{i}") for i, v in enumerate(values.values())],
        *[F.min(v).alias(f"min{i}") for i, v in enumerate(values.values())],
        *[F.max(v).alias(f"max{i}") for i, v in enumerate(values.values())],
    ).first()
    if max(moments[f"n{i}"] for i in range(len(columns))) <= small_group:
        row = df.agg(*[F.percentile(v, F.lit(0.5)).alias(f"med{i}") for i, v in enumerate(values.values())]).first()
        medians = {c: row[f"med{i}"] for i, c in enumerate(columns)}
    else:
        found = exact_quantiles(long_values(df, columns), ["feature"], [0.5], small_group)
        medians = {r["feature"]: r["q"][0] for r in found.collect()}
    rows = []
    for i, c in enumerate(columns):
        total, n = moments["rows"], moments[f"n{i}"]
        if not n:
            continue
        if moments[f"min{i}"] == moments[f"max{i}"]:  # exact: rounding must not look like spread
            rows.append((c, moments[f"min{i}"], moments[f"min{i}"], 0.0))
            continue
        mean, variance, median = moments[f"mean{i}"], moments[f"var{i}"], medians[c]
        missing, delta = total - n, median - mean
        imputed = variance * n / total + delta * delta * n * missing / total / total
        rows.append((c, median, mean + delta * missing / total, math.sqrt(imputed)))
    return df.sparkSession.createDataFrame(rows, "feature string, median double, mean double, std double")


def mode_and_categories(counts: DataFrame) -> DataFrame:
    """(feature, mode, n_categories): most frequent value, the smallest one on a tie."""
    return counts.groupBy("feature").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode"),
        F.count(F.lit(1)).alias("n_categories"),
    )


class _PrepParams(Params):
    categorical = Param(Params._dummy(), "categorical", "text columns", TypeConverters.toListString)
    numerical = Param(Params._dummy(), "numerical", "numeric columns", TypeConverters.toListString)
    wideFrom = Param(Params._dummy(), "wideFrom", "categories from which a text column is wide", TypeConverters.toInt)


class Preprocessor(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Numeric block (median, scale), then categorical block (mode, one-hot without the first)."""

    @keyword_only
    def __init__(self, *, categorical=None, numerical=None, wideFrom=None):
        super().__init__()
        self._setDefault(categorical=CATEGORICAL_FEATURES, numerical=NUMERICAL_FEATURES, wideFrom=WIDE_FROM)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> PreprocessorModel:
        numerical = self.getOrDefault(self.numerical)
        categorical = self.getOrDefault(self.categorical)
        fitted = {"numeric": [], "categorical": []}
        if numerical:
            stats = {r["feature"]: r for r in numeric_statistics(dataset, numerical).collect()}
            for name in numerical:
                if name in stats:  # a column without any value is left out
                    r = stats[name]
                    fitted["numeric"].append(
                        {"name": name, "median": r["median"], "mean": r["mean"], "std": r["std"] or 1.0}
                    )
        if categorical:
            counts = stage(category_counts(dataset, categorical), "categories")
            found = {r["feature"]: r for r in mode_and_categories(counts).collect()}  # one row per column
            wide = sorted(c for c, r in found.items() if r["n_categories"] >= self.getOrDefault(self.wideFrom))
            values: dict[str, list[str]] = {c: [] for c in found}
            for r in counts.where(~F.col("feature").isin(wide)).collect():
                values[r["feature"]].append(r["value"])
            for name in categorical:
                if name in found:
                    entry = {"name": name, "mode": found[name]["mode"], "categories": sorted(values[name])}
                    if name in wide:
                        entry["n_categories"] = found[name]["n_categories"]
                    fitted["categorical"].append(entry)
            if wide:
                fitted["dictionary"] = stage_path(
                    _numbered(counts.where(F.col("feature").isin(wide)), [(c, found[c]["n_categories"]) for c in wide])
                )
        return PreprocessorModel(fitted=json.dumps(fitted))


def stage_path(df: DataFrame) -> str:
    path = new_path(df.sparkSession, "dictionary")
    stage(df, "dictionary", path=path)
    return path


def _numbered(counts: DataFrame, sizes: Sequence[tuple[str, int]]) -> DataFrame:
    """(feature, value, code): the values of each feature numbered from 0 in their order."""
    offset, before = F.lit(0), 0
    for name, n in sizes:  # in the order of the names, as the rows are numbered
        offset = F.when(F.col("feature") == name, before).otherwise(offset)
        before += n
    return with_row_index(counts.select("feature", "value"), ["feature", "value"]).select(
        "feature", "value", (F.col("row_index") - offset).cast("int").alias("code")
    )


class _WithDictionary(DefaultParamsWriter):
    """Saves the categories of wide columns beside the parameters."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.dictionary_path:
            self.sparkSession.read.parquet(self.instance.dictionary_path).write.parquet(f"{path}/dictionary")


class _ReadsDictionary(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        if model.dictionary_path:
            model._set(fitted=json.dumps(model.statistics | {"dictionary": f"{path}/dictionary"}))
        return model


class PreprocessorModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds one double column per output feature; keeps the input columns unless told otherwise.

    A wide column gives one sparse vector column ``{name}_vector`` instead; an unseen value has no entry in it.
    """

    fitted = Param(Params._dummy(), "fitted", "fitted statistics as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, fitted=None):
        super().__init__()
        if fitted is not None:
            self._set(fitted=fitted)

    @property
    def statistics(self) -> dict:
        return json.loads(self.getOrDefault(self.fitted))

    def write(self) -> DefaultParamsWriter:
        return _WithDictionary(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _ReadsDictionary(cls)

    @property
    def dictionary_path(self) -> str | None:
        return self.statistics.get("dictionary")

    @property
    def wide(self) -> dict[str, int]:
        """Wide columns and their numbers of categories."""
        return {c["name"]: c["n_categories"] for c in self.statistics["categorical"] if "n_categories" in c}

    def dictionary(self, name: str) -> DataFrame:
        """(value, code) of a wide column; code 0 is the baseline."""
        rows = SparkSession.active().read.parquet(self.dictionary_path)
        return rows.where(F.col("feature") == name).select("value", "code")

    @property
    def categories(self) -> dict[str, list[str]]:
        """Values of every text column in order; those of a wide one are read from its table."""
        return {
            c["name"]: [r["value"] for r in self.dictionary(c["name"]).orderBy("code").collect()]
            if c["name"] in self.wide else c["categories"]
            for c in self.statistics["categorical"]
        }

    @property
    def feature_names(self) -> list[str]:
        s = self.statistics
        return [n["name"] for n in s["numeric"]] + [
            f"{name}_{v}" for name, values in self.categories.items() for v in values[1:]
        ]

    def encoded_columns(self) -> dict[str, str]:
        """Output name -> SQL text over the raw columns, in feature order."""
        s = self.statistics
        out = {}
        for n in s["numeric"]:
            x = f"CAST(`{n['name']}` AS DOUBLE)"
            filled = f"coalesce(nanvl({x}, NULL), {n['median']!r}D)"
            out[n["name"]] = f"({filled} - {n['mean']!r}D) / {n['std']!r}D"
        for c in s["categorical"]:
            # An unseen value equals no category and gets the code of the baseline.
            value = f"coalesce(CAST(`{c['name']}` AS STRING), {sql_text(c['mode'])})"
            for v in c["categories"][1:]:
                out[f"{c['name']}_{v}"] = f"CAST({value} = {sql_text(v)} AS DOUBLE)"
        return out

    def _with_vectors(self, dataset: DataFrame) -> DataFrame:
        """Add ``{name}_vector`` for every wide column.

        The baseline and unseen values take the last place of the encoder, which it drops.
        """
        modes = {c["name"]: c["mode"] for c in self.statistics["categorical"]}
        for name, n in self.wide.items():
            codes = broadcast_if_small(self.dictionary(name)).select(
                F.col("value").alias("__value"), F.col("code").alias("__code")
            )
            value = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(modes[name]))
            place = F.when(F.col("__code") > 0, F.col("__code") - 1).otherwise(n - 1).cast("double")
            coded = dataset.join(codes, value == F.col("__value"), "left").select(
                *[F.col(f"`{c}`") for c in dataset.columns], place.alias("__place")
            )
            encoder = OneHotEncoder(inputCols=["__place"], outputCols=[f"{name}_vector"], dropLast=True)
            sizes = dataset.sparkSession.createDataFrame([(float(n - 1),)], "__place double")
            dataset = encoder.fit(sizes).transform(coded).drop("__place")
        return dataset

    def encode(self, dataset: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` and the encoded columns only."""
        encoded = [F.expr(e).alias(n) for n, e in self.encoded_columns().items()]
        return self._with_vectors(dataset).select(*keep, *encoded, *[F.col(f"`{c}_vector`") for c in self.wide])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """Add ``features``: the encoded columns as one vector, in the order of ``feature_names``. Raw columns stay."""
        if not self.wide:
            values = F.expr(f"array({', '.join(self.encoded_columns().values())})")
            return dataset.withColumn("features", array_to_vector(values))
        s, parts, narrow = self.statistics, [], []
        rows = self._with_vectors(dataset)

        def close() -> None:
            nonlocal rows
            if narrow:
                parts.append(f"__narrow{len(parts)}")
                rows = rows.withColumn(parts[-1], array_to_vector(F.expr(f"array({', '.join(narrow)})")))
                narrow.clear()

        texts = self.encoded_columns()
        narrow += [texts[n["name"]] for n in s["numeric"]]
        for c in s["categorical"]:
            if c["name"] in self.wide:
                close()
                parts.append(f"{c['name']}_vector")
            else:
                narrow += [texts[f"{c['name']}_{v}"] for v in c["categories"][1:]]
        close()
        whole = VectorAssembler(inputCols=parts, outputCol="features").transform(rows)
        return whole.select(*[F.col(f"`{c}`") for c in dataset.columns], "features")


def sql_text(value: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fitted_statistics(model: PreprocessorModel, spark) -> DataFrame:
    """The fitted numbers as rows: (feature, kind, median, mean, std, mode, n_categories)."""
    s = model.statistics
    rows = [(n["name"], "numeric", n["median"], n["mean"], n["std"], None, None) for n in s["numeric"]]
    rows += [(c["name"], "categorical", None, None, None, c["mode"], c.get("n_categories", len(c["categories"]))) for c in s["categorical"]]
    return spark.createDataFrame(
        rows,
        "feature string, kind string, median double, mean double, std double, mode string, n_categories long",
    )


def fit_and_encode(
    split: DataFrame,
    keep: Sequence[str] = ("customerID", "split", "Churn_Binary"),
    preprocessor: Preprocessor | None = None,
) -> tuple[DataFrame, PreprocessorModel]:
    """Fit on the 'train' rows, encode the rows of both splits in one narrow pass.

    A given preprocessor is fitted anew with its own column lists.
    """
    model = (preprocessor or Preprocessor()).fit(split.where(F.col("split") == "train"))
    return model.encode(split.where(F.col("split").isNotNull()), keep), model
