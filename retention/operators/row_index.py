"""Consecutive row numbers in a global order, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import broadcast_if_small, stage


def with_row_index(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Add 0 … n-1 in the order of ``order``, which must identify a row.

    The rows are range-partitioned and written with their range number, so a
    re-run of a lost task cannot change it. Counts per range become offsets, and
    each range is numbered on its own.
    """
    ranged = stage(
        df.repartitionByRange(*order).withColumn("range", F.spark_partition_id()), "ranges"
    )
    counts = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    # One row per range, that is per shuffle partition.
    offsets = counts.select(
        "range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("offset")
    )
    within = Window.partitionBy("range").orderBy(*order)
    return (
        ranged.join(broadcast_if_small(offsets), "range")
        .withColumn(name, F.col("offset") + F.row_number().over(within) - 1)
        .drop("range", "offset")
    )
