"""Column expressions shared by the operators. All stay inside code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

# A plain decimal number. Keeps out what try_cast would also take: "1.5d", "NaN", "inf".
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def text_to_number(c: Column) -> Column:
    """Number in a text, null for anything that is not a finite decimal number."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(NUMBER_TEXT), text.try_cast("double"))


def is_yes(c: Column) -> Column:
    """True only for 'Yes'; a missing value is False, never null."""
    return c.eqNullSafe(F.lit("Yes"))


def is_positive(df: DataFrame, column: str) -> Column:
    """The positive class by the column's type: 'Yes' in a text, 1 in a number, true in a boolean; never null."""
    kind = df.schema[column].dataType
    value = F.col(f"`{column}`")
    if isinstance(kind, BooleanType):
        return value.eqNullSafe(F.lit(True))
    return value.eqNullSafe(F.lit(1)) if isinstance(kind, NumericType) else is_yes(value)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, 0 where the denominator is 0."""
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def right_closed_bin(column: str, bins: Sequence[tuple[float, float, str]]) -> Column:
    """Label of the bin (low, high] that holds the column; null outside all bins."""
    cases = " ".join(f"WHEN `{column}` > {low} AND `{column}` <= {high} THEN '{label}'" for low, high, label in bins)
    return F.expr(f"CASE {cases} END")


def bin_ordinal(column: str, bins: Sequence[tuple[float, float, str]]) -> Column:
    """Position of the bin that holds the column, null outside all bins."""
    cases = " ".join(f"WHEN `{column}` > {low} AND `{column}` <= {high} THEN {i}" for i, (low, high, _) in enumerate(bins))
    return F.expr(f"CASE {cases} END")
