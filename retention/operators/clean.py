"""Cleaning rules of the raw customer table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ID_COLUMN, LABEL, TARGET
from ..functions.scalar import is_yes, text_to_number


def charges_to_number(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    """Text to number; blanks and garbage become null."""
    return df.withColumn(column, text_to_number(F.col(column)))


def fill_missing_charges(df: DataFrame, column: str = "TotalCharges") -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(0.0)))


def senior_to_text(df: DataFrame, column: str = "SeniorCitizen") -> DataFrame:
    """0 to 'No', 1 to 'Yes', any other value to null."""
    c = F.col(column)
    return df.withColumn(column, F.when(c == 0, "No").when(c == 1, "Yes"))


def add_binary_label(df: DataFrame, target: str = TARGET, label: str = LABEL) -> DataFrame:
    return df.withColumn(label, is_yes(F.col(target)).cast("int"))


def clean(df: DataFrame) -> DataFrame:
    """All four rules; narrow, so the whole of it runs inside the scan stage."""
    return (
        df.transform(charges_to_number)
        .transform(fill_missing_charges)
        .transform(senior_to_text)
        .transform(add_binary_label)
    )


def feature_columns(df: DataFrame) -> list[str]:
    """Columns left for modelling: all but id, target and label."""
    return [c for c in df.columns if c not in (ID_COLUMN, TARGET, LABEL)]


def drop_non_features(df: DataFrame, keep_id: bool = True) -> DataFrame:
    """Features only. The id stays as the key unless the caller drops it."""
    return df.select(*([ID_COLUMN] if keep_id and ID_COLUMN in df.columns else []), *feature_columns(df))


def select_existing(df: DataFrame, wanted: Sequence[str] | None) -> DataFrame:
    """The wanted columns that exist, in the order asked for; all columns if there are none."""
    present = [c for c in wanted or [] if c in df.columns]
    return df.select(*present) if present else df
