"""Exact quantiles of many columns or groups at once, at any number of rows.

The built-in exact percentile keeps every distinct value of a group in one
buffer, so it serves only while the largest group is small. Beyond that a
bounded sketch proposes a bracket around each wanted rank, an exact count
decides on which side the rank lies, and the rows outside are left out of the
next round. The result is exact whatever the sketch returned, and every round
excludes at least the two bracket values, so it ends.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_GROUP = 1_000_000
SKETCH_ACCURACY = 10_000
GRID = [j / 1000.0 for j in range(1001)]


@dataclass
class _Target:
    """The value at 0-based ``rank`` among the ``total`` values of ``key`` in (lo, hi)."""

    tid: int
    key: tuple
    rank: int
    total: int
    lo: float | None = None
    hi: float | None = None


def long_values(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by…, feature, value): the numeric columns as rows, nulls and NaN left out."""
    return (
        df.select(*by, *[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot(list(by), list(columns), "feature", "value")
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def exact_quantiles(
    values: DataFrame,
    keys: Sequence[str],
    probabilities: Sequence[float],
    small_group: int = SMALL_GROUP,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """(keys…, n, q: array<double>), linear interpolation between neighbouring values.

    Any number of groups: only those of more than ``small_group`` rows, of which there are
    few whatever the table, are listed on the driver.
    """
    keys = list(keys)
    counted = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    sizes = counted.where(F.col("n") > small_group).collect()  # at most rows / small_group
    small = values
    if sizes:
        large = values.sparkSession.createDataFrame([tuple(r[k] for k in keys) for r in sizes], values.select(*keys).schema)
        small = values.join(F.broadcast(large), keys, "left_anti")
    direct = small.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile("value", F.array(*[F.lit(float(p)) for p in probabilities])).alias("q"),
    )
    if not sizes:
        return direct

    targets: list[_Target] = []
    plan = []  # (key, n, [(tid below, tid above, share), …])
    for r in sizes:
        key, n, parts = tuple(r[k] for k in keys), r["n"], []
        for p in probabilities:
            position = p * (n - 1)
            pair = []
            for rank in (math.floor(position), math.ceil(position)):
                targets.append(_Target(len(targets), key, rank, n))
                pair.append(targets[-1].tid)
            parts.append((*pair, position - math.floor(position)))
        plan.append((key, n, parts))
    at = _values_at_ranks(values, keys, targets, small_group, accuracy)
    rows = [
        (*key, n, [at[a] + (at[b] - at[a]) * share if share else at[a] for a, b, share in parts])
        for key, n, parts in plan
    ]
    schema = values.select(*keys).schema.add("n", T.LongType()).add("q", T.ArrayType(T.DoubleType()))
    return direct.unionByName(values.sparkSession.createDataFrame(rows, schema))


def _values_at_ranks(values, keys, targets, small_group, accuracy) -> dict[int, float]:
    spark = values.sparkSession
    schema = values.select(*keys).schema
    for name, kind in (("tid", T.IntegerType), ("rank", T.LongType), ("lo", T.DoubleType), ("hi", T.DoubleType)):
        schema = schema.add(name, kind())
    done: dict[int, float] = {}
    open_targets = list(targets)
    while open_targets:
        # At most 2 x probabilities x rows / small_group rows: a tiny share of the table, hence broadcast.
        todo = F.broadcast(
            spark.createDataFrame([(*t.key, t.tid, t.rank, t.lo, t.hi) for t in open_targets], schema)
        )
        rows = values.join(todo, keys).where(
            (F.col("lo").isNull() | (F.col("value") > F.col("lo")))
            & (F.col("hi").isNull() | (F.col("value") < F.col("hi")))
        )
        if max(t.total for t in open_targets) <= small_group:
            upto = F.sum("c").over(Window.partitionBy("tid").orderBy("value"))
            picked = (
                rows.groupBy("tid", "rank", "value")
                .agg(F.count(F.lit(1)).alias("c"))
                .withColumn("upto", upto)
                .where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("c") <= F.col("rank")))
            )
            done.update({r["tid"]: r["value"] for r in picked.select("tid", "value").collect()})
            break
        open_targets = _narrow(spark, rows, open_targets, accuracy, done)
    return done


def _narrow(spark, rows, open_targets, accuracy, done) -> list[_Target]:
    """One round: propose a bracket per target, count around it, keep the part with the rank."""
    sketch = rows.groupBy("tid").agg(F.percentile_approx("value", GRID, accuracy).alias("s")).collect()
    slack = 4.0 / accuracy
    by_tid = {t.tid: t for t in open_targets}
    brackets = []
    for r in sketch:
        t = by_tid[r["tid"]]
        share = t.rank / max(t.total - 1, 1)
        j0 = max(math.floor((share - slack) * 1000), 0)
        j1 = min(math.ceil((share + slack) * 1000), 1000)
        brackets.append((t.tid, r["s"][j0], r["s"][j1]))
    edges = F.broadcast(spark.createDataFrame(brackets, "tid int, a double, b double"))
    v, a, b = F.col("value"), F.col("a"), F.col("b")
    counted = (
        rows.select("tid", "value")
        .join(edges, "tid")
        .groupBy("tid", "a", "b")
        .agg(
            F.count(F.when(v < a, 1)).alias("below"),
            F.count(F.when(v == a, 1)).alias("at_a"),
            F.count(F.when((v > a) & (v < b), 1)).alias("inside"),
            F.count(F.when((v == b) & (a != b), 1)).alias("at_b"),
        )
        .collect()
    )
    following = []
    for r in counted:
        t = by_tid[r["tid"]]
        before = 0
        parts = (
            (r["below"], t.lo, r["a"]),
            (r["at_a"], r["a"], None),
            (r["inside"], r["a"], r["b"]),
            (r["at_b"], r["b"], None),
        )
        for i, (n, lo, hi) in enumerate(parts):
            if t.rank < before + n:
                if i in (1, 3):
                    done[t.tid] = lo
                else:
                    following.append(_Target(t.tid, t.key, t.rank - before, n, lo, hi))
                break
            before += n
        else:
            following.append(_Target(t.tid, t.key, t.rank - before, t.total - before, r["b"], t.hi))
    return following
