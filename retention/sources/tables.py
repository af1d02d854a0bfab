"""Reading the raw table, writing and reading the split tables, writing predictions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..config import MISSING_TOKENS, RAW_NUMERIC_TYPES


# Quotes inside a quoted value are doubled, as spreadsheets and data frames write them.
CSV = {"header": True, "quote": '"', "escape": '"'}


def read_raw(spark: SparkSession, path: str, file_format: str = "csv", multi_line: bool = False) -> DataFrame:
    """The raw customer table by column name.

    CSV columns are read as text without an inference pass; missing-value tokens
    become null and the numeric columns are cast. A bad number becomes null, and
    so does a fraction in a whole-number column ("3.0" is a whole number).
    A blank " " is a value, not a missing token. Unknown columns stay text.
    ``multi_line`` allows line breaks inside quoted values; such a file is read by one task.
    """
    if file_format != "csv":
        return spark.read.format(file_format).load(path)
    raw = spark.read.options(**CSV, multiLine=multi_line).csv(path)
    columns = []
    for name in raw.columns:
        c = F.col(f"`{name}`")
        value = F.when(~c.isin(MISSING_TOKENS), c)
        kind = RAW_NUMERIC_TYPES.get(name)
        if kind:
            number = F.trim(value).try_cast("double")
            value = number if kind == "double" else F.when(number == F.floor(number), number.try_cast(kind))
        columns.append(value.alias(name))
    return raw.select(*columns)


def write_raw_csv(df: DataFrame, path: str) -> str:
    """CSV with header that keeps blanks as they are."""
    (
        df.write.options(**CSV)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_split(df: DataFrame, path: str, file_format: str = "parquet") -> dict[str, str]:
    """Write rows that carry a ``split`` column, one folder per split; the label stays in its row."""
    writer = df.write.mode("overwrite").partitionBy("split").format(file_format)
    if file_format == "csv":
        writer = writer.options(**CSV)
    writer.save(path)
    return {name: f"{path}/split={name}" for name in ("train", "test")}


def read_split(
    spark: SparkSession, path: str, split: str | None = None, file_format: str = "parquet", schema: StructType | str | None = None
) -> DataFrame:
    """Rows of one split (only its folder is read) or of both.

    Text files keep no types: give the ``schema`` of the written table (without ``split``), or all columns are text.
    """
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.options(**CSV)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    return df.where(F.col("split") == split) if split else df


def write_predictions(df: DataFrame, folder: str, file_format: str = "csv", run_id: str | None = None) -> str:
    """Write a prediction table to a folder of its own run; earlier runs stay."""
    path = f"{folder.rstrip('/')}/test_predictions_{run_id or uuid.uuid4().hex}"
    writer = df.write.format(file_format)
    if file_format == "csv":
        writer = writer.options(**CSV)
    writer.save(path)
    return path
