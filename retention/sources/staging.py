"""Size-checked broadcasts and tables written to the shared folder of the cluster."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
ROWS_PER_TASK = 500_000
LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in LOCAL_FOLDERS:
        LOCAL_FOLDERS[context.applicationId] = tempfile.mkdtemp(prefix="retention-")
    return LOCAL_FOLDERS[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/retention/{name}-{uuid.uuid4().hex}"


def path_for_now(spark: SparkSession, name: str) -> tuple[str, Callable[[], None]]:
    """A new path in the shared folder, with a function that deletes what was written there."""
    path = new_path(spark, name)

    def delete() -> None:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    return path, delete


def stage_for_now(df: DataFrame, name: str, partition_by: str | None = None) -> tuple[DataFrame, Callable[[], None]]:
    """Like ``stage``, with a function that deletes the written files once nothing reads them any more."""
    path, delete = path_for_now(df.sparkSession, name)
    return stage(df, name, partition_by, path), delete


def stage(df: DataFrame, name: str, partition_by: str | None = None, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet in the shared folder and read it back.

    Cuts the lineage like a checkpoint, and later readers keep column pruning
    and filter pushdown. A lost executor re-reads files and recomputes nothing.
    With ``partition_by`` a reader of one value opens its files only.
    """
    path = path or new_path(df.sparkSession, name)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of an action in here are removed when it ends, not when the driver's garbage is collected."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a shuffle of so many rows: a task gets about ``ROWS_PER_TASK``, however large the table."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_TASK))


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast an aggregated table after counting that it has at most ``limit`` rows.

    A larger table is returned as it is, and the join stays a shuffle join.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
