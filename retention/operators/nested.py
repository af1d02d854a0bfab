"""Many trees out of one: cuts of fitted trees and forests by depth, size of a split and number of trees.

A tree is grown from the top, so the tree of a smaller depth, or of a larger
minimum size of a split, is a part of the deeper one: the nodes at the depth, or
with too few rows, become leaves. One fit therefore answers every depth and
every minimum size. The first n trees of a forest are taken as the forest of n.

The nodes come from the table that the model writer produces; a cut of a saved
model is made there, by joins. Scoring looks up, for the leaf of every row, what
each cut predicts there: one narrow pass that ends in four counts per cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Model, Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.staging import path_for_now
from .metrics import CONFUSION

LOOKUPS = 1_000_000  # rows times trees looked up together


def smallest_split(value: int | float | None, rows: int) -> int:
    """Rows a node needs to be split; a fraction counts of all rows, as ``min_samples_split`` has it."""
    if value is None:
        return 2
    return max(2, math.ceil(value * rows) if isinstance(value, float) else int(value))


def flat_nodes(spark: SparkSession, path: str) -> DataFrame:
    """Nodes of a saved tree or forest with the tree's number; a single tree is number 0."""
    saved = spark.read.parquet(f"{path}/data")
    return saved.select("treeID", "nodeData.*") if "treeID" in saved.columns else saved.withColumn("treeID", F.lit(0))


def without_small_splits(model: Model, smallest: int) -> Model:
    """The model whose nodes of fewer than ``smallest`` rows are leaves; in a forest a drawn row counts as often as drawn.

    A child has fewer rows than its parent, so a node stays if its parent may be
    split. Nodes are numbered anew, in the order that the model reader expects.
    """
    if smallest <= 2:
        return model
    spark = SparkSession.active()
    path, delete = path_for_now(spark, "tree")
    model.write().save(f"{path}/whole")
    nodes = flat_nodes(spark, f"{path}/whole")
    splits = (F.col("leftChild") >= 0) & (F.col("rawCount") >= smallest)
    children = nodes.where(splits).select("treeID", F.explode(F.array("leftChild", "rightChild")).alias("id"))
    kept = nodes.where(F.col("id") == 0).unionByName(nodes.join(children, ["treeID", "id"], "left_semi"))
    numbered = kept.withColumn("number", (F.row_number().over(Window.partitionBy("treeID").orderBy("id")) - 1).cast("int"))
    right = numbered.select("treeID", F.col("id").alias("rightChild"), F.col("number").alias("right"))
    nothing = F.struct(
        F.lit(-1).alias("featureIndex"),
        F.array().cast("array<double>").alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    fields = F.struct(
        F.col("number").alias("id"),
        "prediction",
        "impurity",
        "impurityStats",
        "rawCount",
        F.when(splits, F.col("gain")).otherwise(-1.0).alias("gain"),
        F.when(splits, F.col("number") + 1).otherwise(-1).alias("leftChild"),
        F.when(splits, F.col("right")).otherwise(-1).alias("rightChild"),
        F.when(splits, F.col("split")).otherwise(nothing).alias("split"),
    ).alias("nodeData")
    cut = numbered.join(right, ["treeID", "rightChild"], "left").select("treeID", fields)
    spark.read.text(f"{path}/whole/metadata").coalesce(1).write.text(f"{path}/cut/metadata")
    if hasattr(model, "trees"):
        spark.read.parquet(f"{path}/whole/treesMetadata").write.parquet(f"{path}/cut/treesMetadata")
        cut.write.parquet(f"{path}/cut/data")
    else:
        cut.select("nodeData.*").write.parquet(f"{path}/cut/data")
    smaller = type(model).load(f"{path}/cut")  # its nodes are read here
    delete()
    return smaller


def leaf_values(nodes: pd.DataFrame, cuts: Sequence[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(first leaf of every tree, what each cut predicts at every leaf).

    ``nodes`` has a row per node (treeID, id, prediction, rawCount, leftChild,
    rightChild); a cut is (depth, smallest split). Leaves are numbered in the order of their ids,
    as the model numbers them. Levels are walked down, all trees side by side.
    """
    nodes = nodes.sort_values(["treeID", "id"])
    tree, left, right = (nodes[c].to_numpy() for c in ("treeID", "leftChild", "rightChild"))
    prediction, rows = nodes["prediction"].to_numpy(), nodes["rawCount"].to_numpy()
    start = np.searchsorted(tree, tree)  # place of the tree's root
    depths, smallest = (np.array(x) for x in zip(*cuts))
    value = np.repeat(prediction[:, None], len(cuts), axis=1)
    done = np.zeros(value.shape, bool)
    level, depth = np.flatnonzero(nodes["id"].to_numpy() == 0), 0
    while len(level):
        done[level] |= (depths == depth) | (rows[level][:, None] < smallest)
        parents = level[left[level] >= 0]
        level = np.concatenate([start[parents] + left[parents], start[parents] + right[parents]])
        above = np.concatenate([parents, parents])
        value[level] = np.where(done[above], value[above], value[level])
        done[level] = done[above]
        depth += 1
    leaves = left < 0
    first = np.concatenate([[0], np.cumsum(np.bincount(tree[leaves]))[:-1]])
    return first, value[leaves]


def cut_confusion(
    model: Transformer,
    rows: DataFrame,
    cuts: Mapping[int, tuple[int, int, int]],
    label: str,
    features: str = "features",
) -> DataFrame:
    """(point and the four counts) of the cuts (depth, smallest split, number of trees) of a fitted tree or forest.

    Labels are 0/1; rows without a label are left out. The looked-up table has
    a line per leaf, so it is of the size of the model, which its scoring sends anyway.
    """
    spark = rows.sparkSession
    path, delete = path_for_now(spark, "tree")
    model.write().save(path)
    names = ["treeID", "id", "prediction", "rawCount", "leftChild", "rightChild"]
    nodes = flat_nodes(spark, path).select(*names).toArrow().to_pandas()  # the model, which the driver holds anyway
    delete()
    shapes = list(dict.fromkeys((d, s) for d, s, _ in cuts.values()))
    wanted = [(point, shapes.index((d, s)), n) for point, (d, s, n) in cuts.items()]
    table = spark.sparkContext.broadcast(leaf_values(nodes, shapes))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first, values = table.value
        found = np.zeros((len(wanted), 4), np.int64)
        for batch in batches:
            for at in range(0, len(batch), max(1, LOOKUPS // len(first))):
                part = batch.iloc[at:at + max(1, LOOKUPS // len(first))]
                leaf = np.stack(part["leaf"].to_numpy()).astype(np.int64) + first
                positive = part["label"].to_numpy() == 1
                for shape in range(values.shape[1]):
                    sums = np.add.accumulate(values[:, shape][leaf], axis=1)  # in the order of the trees
                    for place, (_, s, n) in enumerate(wanted):
                        if s == shape:
                            says = sums[:, n - 1] / n > 0.5
                            found[place] += [
                                (~says & ~positive).sum(), (says & ~positive).sum(),
                                (~says & positive).sum(), (says & positive).sum(),
                            ]
        out = pd.DataFrame(found, columns=CONFUSION)
        out.insert(0, "point", [point for point, _, _ in wanted])
        yield out

    leafy = model.copy()
    leafy.setLeafCol("leaf")
    leaves = leafy.transform(rows.where(F.col(label).isNotNull()).select(F.col(label).alias("label"), features))
    leaf = vector_to_array("leaf") if hasattr(model, "trees") else F.array("leaf")
    counted = leaves.select("label", leaf.alias("leaf")).mapInPandas(
        count, "point int, " + ", ".join(f"{c} long" for c in CONFUSION)
    )
    return counted.groupBy("point").agg(*[F.sum(c).alias(c) for c in CONFUSION])
