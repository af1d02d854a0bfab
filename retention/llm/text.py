"""Small helpers that several operators share: Arrow batches, salts and tables of bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 2_000_000
LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: Lower-cases A-Z and blanks everything that is no ASCII letter, digit or part of a non-ASCII character.
WORD_TABLE = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)


def two_columns(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The id and the text alone, a null text as an empty one; other columns of any name stay out."""
    return docs.select(docs[f"`{id_col}`"].alias("id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))


def with_rows(docs: DataFrame, text_col: str) -> DataFrame:
    """Like ``two_columns`` with the whole row, as one struct, in place of the id.

    A text that is a string crosses to Python once, inside the row, where ``blocks`` finds it; the column ``text`` then
    holds its place there.
    """
    row = F.struct(*[docs[f"`{c}`"].alias(c) for c in docs.columns])
    if text_col in docs.columns and docs.schema[text_col].dataType == T.StringType():
        return docs.select(row.alias("id"), F.lit(docs.columns.index(text_col)).alias("text"))
    return docs.select(row.alias("id"), F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")).alias("text"))


def out_schema(source: DataFrame, **fields: str) -> T.StructType:
    """The id of ``source`` and further fields of the given types."""
    return T.StructType([source.schema["id"], *T.StructType.fromDDL(", ".join(f"{k} {v}" for k, v in fields.items())).fields])


def blocks(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) in runs of about ``limit`` bytes of text, one text at least; an empty text for a null in a row of ``with_rows``."""
    for batch in batches:
        texts = batch.column(1)
        if pa.types.is_integer(texts.type) and batch.num_rows:
            texts = pc.fill_null(batch.column(0).field(texts[0].as_py()), "")
        sizes = pc.binary_length(texts).to_pylist()
        start, held = 0, 0
        for i, size in enumerate(sizes):
            held += size
            if held >= limit or i + 1 == len(sizes):
                yield batch.column(0).slice(start, i + 1 - start), texts.slice(start, i + 1 - start).to_pylist()
                start, held = i + 1, 0


def list_array(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, every other character as it is. Pure ASCII texts take the built-in's fast path."""
    capitals = "".join(map(chr, range(0x41, 0x5B)))
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, capitals, capitals.lower())
    )


def restored(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of the rows in ``id``, as they were."""
    return df.select(*[F.col("id").getField(c).alias(c) for c in columns])
