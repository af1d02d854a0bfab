"""Stratified splits and folds with exact sizes, without moving the rows.

Rows are ordered inside each class by the md5 of seed and id. A split is then a
set of cut keys in that order: ``fit_cuts`` finds the key at each wanted rank by
counting key prefixes (two to three narrow scans of id and label), and the rows
are tagged by comparing their own key with at most a handful of literals. The
wide rows are never shuffled or sorted, and the outcome does not depend on the
partitioning.

Labels of many classes go through tables instead: the wanted ranks and the open
buckets are joined to the prefix counts, and the cuts are joined to the rows.
The order, and so the outcome, is the same.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CV_FOLDS, ID_COLUMN, LABEL, SEED, TEST_SIZE
from ..sources.staging import broadcast_if_small, stage, tasks_for
from .row_index import with_row_index

PREFIX_STEP = 3  # hex digits per refinement: 4,096 buckets
MAX_BUCKET_ROWS = 2_000_000
FEW_CLASSES = 32  # as many become literals of the plan


@dataclass(frozen=True)
class Cut:
    """Last key that still belongs to the first ``rank`` rows of its class."""

    label: int
    rank: int
    key: str
    id: object


def order_key(id_column: str = ID_COLUMN, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(id_column).cast("string"), F.lit(""))))


def class_counts(df: DataFrame, label: str = LABEL) -> dict[int, int]:
    """Rows per class of a classifier's label, whose values are 0 and 1."""
    return {r[0]: r[1] for r in df.groupBy(label).count().collect() if r[0] is not None}


def few_class_counts(counts: DataFrame, few: int) -> dict[int, int] | None:
    """The counts of at most ``few`` classes, None if there are more."""
    rows = counts.limit(few + 1).collect()
    return {r["class"]: r["n"] for r in rows} if len(rows) <= few else None


def counts_table(df: DataFrame, label: str) -> DataFrame:
    """(class, n) of all classes."""
    return df.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))


def fit_cuts(
    df: DataFrame,
    ranks: Callable[[int, int], list[int]],
    id_column: str = ID_COLUMN,
    label: str = LABEL,
    seed: int = SEED,
    max_bucket_rows: int = MAX_BUCKET_ROWS,
    counts: dict[int, int] | None = None,
) -> list[Cut]:
    """The cut at each rank of ``ranks(class, n)`` in every class of n rows. ``counts`` are the classes' rows if known.

    Only buckets that hold a wanted rank are looked at again, with longer
    prefixes, until each is small enough to be sorted as one group. Copies of
    one id share a key and always fall on the same side.
    """
    keyed = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("label"), F.col(id_column).alias("id"), order_key(id_column, seed).alias("key")
    )
    # (class, prefix) -> [(wanted rank, rows of the class before the prefix)]
    open_buckets: dict[tuple[int, str], list[tuple[int, int]]] = {}
    ready: dict[tuple[int, str], list[tuple[int, int]]] = {}
    for c, n in sorted((class_counts(df, label) if counts is None else counts).items()):
        targets = [(r, 0) for r in ranks(c, n) if 0 < r <= n]
        if targets:
            (ready if n <= max_bucket_rows else open_buckets)[c, ""] = targets
    length = 0
    while open_buckets:
        length += PREFIX_STEP
        counts = (
            keyed.where(_in_buckets(open_buckets, length - PREFIX_STEP))
            .groupBy("label", F.substring("key", 1, length).alias("prefix"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        # At most 4,096 rows per open bucket; the running count stays in Spark.
        parent = F.substring("prefix", 1, length - PREFIX_STEP) if length > PREFIX_STEP else F.lit("")
        in_parent = Window.partitionBy("label", "parent").orderBy("prefix")
        running = counts.withColumn("parent", parent).withColumn("upto", F.sum("n").over(in_parent))
        hit = None
        for (c, p), targets in open_buckets.items():
            for r, before in targets:
                cond = (
                    (F.col("label") == c)
                    & (F.col("parent") == p)
                    & (F.col("upto") >= r - before)
                    & (F.col("upto") - F.col("n") < r - before)
                )
                hit = cond if hit is None else hit | cond
        found = running.where(hit).collect()
        following: dict[tuple[int, str], list[tuple[int, int]]] = {}
        for row in found:
            lo, hi = row["upto"] - row["n"], row["upto"]
            small = row["n"] <= max_bucket_rows or length + PREFIX_STEP > 32
            for r, before in open_buckets[row["label"], row["parent"]]:
                if lo < r - before <= hi:
                    target = ready if small else following
                    target.setdefault((row["label"], row["prefix"]), []).append((r, before + lo))
        open_buckets = following
    return _cuts_in_buckets(keyed, ready)


def _in_buckets(buckets, length: int) -> Column:
    if length == 0:
        return F.lit(True)
    cond = F.lit(False)
    for c, p in buckets:
        cond = cond | ((F.col("label") == c) & (F.substring("key", 1, length) == p))
    return cond


def _cuts_in_buckets(keyed: DataFrame, ready) -> list[Cut]:
    if not ready:
        return []
    cond, prefix = F.lit(False), F.lit(None).cast("string")
    for c, p in ready:
        here = (F.col("label") == c) & F.col("key").startswith(p)
        cond = cond | here
        prefix = F.when(here, p).otherwise(prefix)
    distinct = (
        keyed.where(cond)
        .withColumn("prefix", prefix)
        .groupBy("label", "prefix", "key", "id")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(Window.partitionBy("label", "prefix").orderBy("key", "id")))
    )
    hit = F.lit(False)
    for (c, p), targets in ready.items():
        for r, before in targets:
            hit = hit | (
                (F.col("label") == c)
                & (F.col("prefix") == p)
                & (F.col("upto") >= r - before)
                & (F.col("upto") - F.col("n") < r - before)
            )
    cuts = []
    for row in distinct.where(hit).collect():
        for r, before in ready[row["label"], row["prefix"]]:
            if row["upto"] - row["n"] < r - before <= row["upto"]:
                cuts.append(Cut(row["label"], r, row["key"], row["id"]))
    return sorted(cuts, key=lambda c: (c.label, c.rank))


def _at_or_before(cut: Cut, id_column: str, label: str, seed: int) -> Column:
    key = order_key(id_column, seed)
    return (F.col(label) == cut.label) & (
        (key < cut.key) | ((key == cut.key) & ((F.col(id_column) <= F.lit(cut.id)) if cut.id is not None else F.lit(True)))
    )


def cut_table(
    df: DataFrame,
    targets: DataFrame,
    id_column: str = ID_COLUMN,
    label: str = LABEL,
    seed: int = SEED,
    max_bucket_rows: int = MAX_BUCKET_ROWS,
) -> DataFrame:
    """(class, rank, key, id): the cut at every rank of ``targets`` (class, n, rank), for any number of classes.

    Like ``fit_cuts``, with the open buckets as a table: a level counts the rows of
    its buckets by a longer prefix and keeps the bucket that holds the rank. Small
    buckets are sorted in as many tasks as their rows need.
    """
    keyed = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("class"), F.col(id_column).alias("id"), order_key(id_column, seed).alias("key")
    )
    wanted = targets.where(F.col("rank").between(1, F.col("n"))).select(
        "class", F.lit("").alias("prefix"), "n", "rank", F.lit(0).cast("long").alias("before")
    )
    length, found = 0, None
    here = F.col("rank") - F.col("before")
    inside = (F.col("upto") >= here) & (F.col("upto") - F.col("rows") < here)
    while True:
        wanted = stage(wanted, "ranks")
        last = length + PREFIX_STEP > 32
        small = F.lit(True) if last else F.col("n") <= max_bucket_rows
        sorted_now = wanted.where(small)
        rows = sorted_now.select("class", "prefix", "n").distinct().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        cuts = (
            _rows_of(keyed, sorted_now, length, tasks_for(df.sparkSession, rows))
            .withColumn("number", F.row_number().over(Window.partitionBy("class", "prefix").orderBy("key", "id")))
            .join(sorted_now, ["class", "prefix"])
            .where(F.col("number") - here == 0)  # no key of the join, so the rows are not dealt again
            .select("class", "rank", "key", "id")
        )
        found = cuts if found is None else found.unionByName(cuts)
        large = wanted.where(~small)
        if large.isEmpty():
            return stage(found, "cuts")
        length += PREFIX_STEP
        in_bucket = Window.partitionBy("class", "prefix").orderBy("longer")  # at most 4,096 rows
        wanted = (
            _rows_of(keyed, large, length - PREFIX_STEP)
            .groupBy("class", "prefix", F.substring("key", 1, length).alias("longer"))
            .agg(F.count(F.lit(1)).alias("rows"))
            .withColumn("upto", F.sum("rows").over(in_bucket))
            .join(large.drop("n"), ["class", "prefix"])
            .where(inside)
            .select(
                "class", F.col("longer").alias("prefix"), F.col("rows").alias("n"), "rank",
                (F.col("before") + F.col("upto") - F.col("rows")).alias("before"),
            )
        )


def _rows_of(keyed: DataFrame, buckets: DataFrame, length: int, tasks: int | None = None) -> DataFrame:
    """The keyed rows of the buckets, with their prefix of ``length`` digits; dealt by bucket to so many ``tasks``."""
    wanted = buckets.select("class", "prefix").distinct()
    few = broadcast_if_small(wanted)
    rows = keyed.withColumn("prefix", F.substring("key", 1, length))
    if tasks is None:
        return rows.join(few, ["class", "prefix"], "left_semi")
    if few is wanted:  # the join needs the same deal
        return rows.repartition(tasks, "class", "prefix").join(few, ["class", "prefix"], "left_semi")
    return rows.join(few, ["class", "prefix"], "left_semi").repartition(tasks, "class", "prefix")


def with_cuts(df: DataFrame, cuts: DataFrame, id_column: str, label: str, seed: int) -> DataFrame:
    """Add ``__before``: how many cuts of the row's class lie before it, and ``__cuts``: how many it has."""
    of_class = cuts.groupBy(F.col("class").alias("__class")).agg(
        F.collect_list(F.struct("key", F.col("id").alias("last"))).alias("__list")  # one per rank of the class
    )
    key = order_key(id_column, seed)
    before = F.filter("__list", lambda c: ~(
        (key < c["key"]) | ((key == c["key"]) & F.coalesce(F.col(id_column) <= c["last"], F.lit(True)))
    ))
    return df.join(broadcast_if_small(of_class), F.col(label) == F.col("__class"), "left").select(
        *df.columns,
        F.coalesce(F.size(before), F.lit(0)).alias("__before"),
        F.when(F.col("__list").isNull(), 0).otherwise(F.size("__list")).alias("__cuts"),
    )


def ranks_for_test(counts: DataFrame, test_size: float) -> DataFrame:
    """(class, n, rank): test rows per class as ``rows_for_test`` has them, for any number of classes."""
    exact = F.col("n") * F.lit(float(test_size))
    shares = counts.withColumn("rank", F.floor(exact)).withColumn("short", F.col("rank") - exact)
    total, given = shares.agg(F.sum("n"), F.sum("rank")).first()
    missing = max(0, min(math.ceil((total or 0) * test_size), total or 0) - (given or 0))
    return with_row_index(shares, ["short", "class"], "place").select(
        "class", "n", (F.col("rank") + (F.col("place") < missing).cast("long")).alias("rank")
    )


def rows_for_test(counts: dict[int, int], test_size: float) -> dict[int, int]:
    """Test rows per class: ceil(test_size * all rows) in total, shared out by largest remainder."""
    exact = {c: n * test_size for c, n in counts.items()}
    shares = {c: math.floor(x) for c, x in exact.items()}
    missing = min(math.ceil(sum(counts.values()) * test_size), sum(counts.values())) - sum(shares.values())
    for c in sorted(exact, key=lambda c: (shares[c] - exact[c], c))[: max(0, missing)]:
        shares[c] += 1
    return shares


def stratified_split(
    df: DataFrame,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    id_column: str = ID_COLUMN,
    label: str = LABEL,
    few_classes: int = FEW_CLASSES,
    **limits,
) -> DataFrame:
    """Add ``split``: in every class the first rows are 'test', ceil(test_size * n) of all rows in total.

    Rows without a label cannot be stratified and get a null split.
    """
    table = counts_table(df, label)
    counts = few_class_counts(table, few_classes)
    if counts is None:
        table = stage(table, "classes")
        cuts = cut_table(df, ranks_for_test(table, test_size), id_column, label, seed, **limits)
        in_test = (F.col("__cuts") > 0) & (F.col("__before") == 0)
        return with_cuts(df, cuts, id_column, label, seed).select(
            *df.columns, F.when(F.col(label).isNotNull(), F.when(in_test, "test").otherwise("train")).alias("split")
        )
    shares = rows_for_test(counts, test_size)
    cuts = fit_cuts(df, lambda c, n: [shares[c]], id_column, label, seed, counts=counts, **limits)
    in_test = F.lit(False)
    for cut in cuts:
        in_test = in_test | _at_or_before(cut, id_column, label, seed)
    return df.withColumn(
        "split", F.when(F.col(label).isNotNull(), F.when(in_test, "test").otherwise("train"))
    )


def fold_ranks(n: int, k: int) -> list[int]:
    return [n * f // k for f in range(1, k)]


def stratified_folds(
    df: DataFrame,
    k: int = CV_FOLDS,
    seed: int = SEED,
    id_column: str = ID_COLUMN,
    label: str = LABEL,
    few_classes: int = FEW_CLASSES,
    **limits,
) -> DataFrame:
    """Add ``fold`` 0 … k-1: equal stretches of every class, sizes differ by at most one row."""
    table = counts_table(df, label)
    counts = few_class_counts(table, few_classes)
    if counts is None:
        table = stage(table, "classes")
        ranks = table.withColumn("rank", F.explode(F.expr(f"transform(sequence(1, {k} - 1), f -> n * f div {k})")))
        cuts = cut_table(df, ranks if k > 1 else ranks.where(F.lit(False)), id_column, label, seed, **limits)
        fold = F.col("__before") + (k - 1) - F.col("__cuts")  # ranks of 0 rows have no cut
        return with_cuts(df, cuts, id_column, label, seed).select(
            *df.columns, F.when(F.col(label).isNotNull(), fold).cast("int").alias("fold")
        )
    cuts = fit_cuts(df, lambda c, n: fold_ranks(n, k), id_column, label, seed, counts=counts, **limits)
    # A class smaller than k yields equal ranks; count how many cuts lie before the row.
    fold = F.lit(0)
    for c in sorted({cut.label for cut in cuts}):
        of_class = [cut for cut in cuts if cut.label == c]
        empty = (k - 1) - len(of_class)  # ranks of 0 rows: those folds have no row of the class
        passed = F.lit(empty)
        for cut in of_class:
            passed = passed + F.when(_at_or_before(cut, id_column, label, seed), 0).otherwise(1)
        fold = F.when(F.col(label) == c, passed).otherwise(fold)
    return df.withColumn("fold", F.when(F.col(label).isNotNull(), fold).cast("int"))


def append_rows(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows of both tables, duplicates kept, columns matched by name."""
    return train.unionByName(test)


def segment_rows(df: DataFrame, column: str, value) -> DataFrame:
    """Rows of one segment; the filter reaches the scan."""
    return df.where(F.col(column) == F.lit(value))
