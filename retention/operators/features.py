"""Derived features. Stateless and narrow: no shuffle, no pass over the data."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import SELECTED_FEATURES, SERVICE_COLUMNS, SERVICE_COUNT_BINS, TENURE_BINS
from ..functions.scalar import bin_ordinal, right_closed_bin
from ..sources.staging import BROADCAST_ROWS
from .clean import select_existing

TEXT_TYPES = (T.StringType, T.CharType, T.VarcharType)


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, TEXT_TYPES)]


def fixed_domain_dummies(df: DataFrame, column: str, labels: Iterable[str], prefix: str) -> DataFrame:
    """One boolean per label of a known domain; all false for a null value."""
    return df.withColumns({f"{prefix}_{label}": F.col(column).eqNullSafe(label) for label in labels})


def add_tenure_groups(df: DataFrame, column: str = "tenure") -> DataFrame:
    grouped = df.withColumns({
        "tenure_group": right_closed_bin(column, TENURE_BINS),
        "tenure_group_ordinal": bin_ordinal(column, TENURE_BINS),
    })
    return fixed_domain_dummies(grouped, "tenure_group", [b[2] for b in TENURE_BINS], "tenure_group")


def add_service_count(df: DataFrame, service_columns: Sequence[str] | None = None) -> DataFrame:
    """Number of services: 'Yes' in a text column counts 1, a numeric column counts its value."""
    wanted = SERVICE_COLUMNS if service_columns is None else service_columns
    kinds = {f.name: f.dataType for f in df.schema.fields}
    terms = ["0"]
    for name in wanted:
        if name not in kinds:
            continue
        if isinstance(kinds[name], TEXT_TYPES):
            terms.append(f"CAST(`{name}` <=> 'Yes' AS INT)")
        elif isinstance(kinds[name], T.BooleanType):
            terms.append(f"CAST(`{name}` AS INT)")
        else:
            terms.append(f"`{name}`")
    counted = df.withColumn("service_count", F.expr(" + ".join(terms)))
    grouped = counted.withColumns({
        "service_count_group": right_closed_bin("service_count", SERVICE_COUNT_BINS),
        "service_count_group_ordinal": bin_ordinal("service_count", SERVICE_COUNT_BINS),
    })
    return fixed_domain_dummies(
        grouped, "service_count_group", [b[2] for b in SERVICE_COUNT_BINS], "service_count"
    )


def add_charge_ratio(df: DataFrame) -> DataFrame:
    """tenure / (MonthlyCharges + 1); null where the denominator is 0 (no infinity in a feature)."""
    if not {"tenure", "MonthlyCharges"} <= set(df.columns):
        return df
    return df.withColumn(
        "tenure_to_monthly_ratio",
        F.try_divide(F.col("tenure").cast("double"), F.col("MonthlyCharges") + F.lit(1.0)),
    )


def add_contract_tenure(df: DataFrame) -> DataFrame:
    """{column}_tenure = column * tenure for every non-text column named after the contract."""
    if "tenure" not in df.columns:
        return df
    text = set(text_columns(df))
    products = {}
    for field in df.schema.fields:
        if ("Contract" in field.name or "contract" in field.name) and field.name not in text:
            c = F.col(f"`{field.name}`")
            if isinstance(field.dataType, T.BooleanType):
                c = c.cast("int")
            products[f"{field.name}_tenure"] = c * F.col("tenure")
    return df.withColumns(products) if products else df


def add_interactions(df: DataFrame) -> DataFrame:
    return df.transform(add_charge_ratio).transform(add_contract_tenure)


def engineer(
    df: DataFrame,
    groups: bool = True,
    counts: bool = True,
    interactions: bool = True,
    select: bool = False,
    selected: Sequence[str] | None = None,
) -> DataFrame:
    """All derived features, each family switchable."""
    if groups:
        df = add_tenure_groups(df)
    if counts:
        df = add_service_count(df)
    if interactions:
        df = add_interactions(df)
    if select:
        df = select_existing(df, SELECTED_FEATURES if selected is None else selected)
    return df


def segment_mapping(
    df: DataFrame,
    columns: Sequence[str] = ("Contract",),
    categories: dict[str, list[str]] | None = None,
) -> DataFrame:
    """(column, value, encoded_column) for the values of ``df`` that have an encoded column.

    ``categories`` holds the fitted, sorted categories; the first one is the
    baseline and has no column, so its value is absent. An underscore in a
    category also stands for a space. Columns not in ``df`` are skipped.
    """
    spark = df.sparkSession
    present = [c for c in columns if c in df.columns and c in (categories or {})]
    schema = "column string, value string, encoded_column string"
    fitted, seen = [], set()
    for c in present:
        for category in categories[c][1:]:
            # First match wins: a category takes its own text, then the one with spaces.
            for value in (category, category.replace("_", " ")):
                if (c, value) not in seen:
                    seen.add((c, value))
                    fitted.append((c, value, f"{c}_{category}"))
    lookup = spark.createDataFrame(fitted, schema)
    if not present:
        return lookup
    values = (
        df.select(*[F.col(c).cast("string").alias(c) for c in present])
        .unpivot([], present, "column", "value")
        .where(F.col("value").isNotNull())
        .distinct()
    )
    small = F.broadcast(lookup) if len(fitted) <= BROADCAST_ROWS else lookup
    return values.join(small, ["column", "value"]).select("column", "value", "encoded_column")
