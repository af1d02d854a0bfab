"""Connected components of a link table as rounds of joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.sources.staging import stage_for_now

ROUNDS = 60


def _fewest(edges: DataFrame) -> DataFrame:
    return edges.filter("a <> b").distinct()


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours are linked to the least node around it.

    The minimum is combined before the shuffle; the join back is a plain equality join,
    which Spark splits where a node has many neighbours.
    """
    sides = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if larger else edges
    least = sides.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = sides.join(least, "a")
    if larger:
        return _fewest(joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
    down = joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _fewest(down.unionByName(least.select("a", F.col("m").alias("b"))))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root the least node that it reaches.

    Alternates the two star steps until the links stay as they are; the rounds grow with
    the logarithm of the nodes. Every round is written to the shared folder, so a lost
    executor replays one round at most, and only two numbers per round reach the driver. The
    round before is deleted.
    """
    def seen(df: DataFrame):
        row = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        return row["n"], row["h"]

    directed = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, delete = stage_for_now(_fewest(directed), "links")
    before = seen(edges)
    for _ in range(ROUNDS):
        if not before[0]:
            break
        edges, delete_next = stage_for_now(_star(_star(edges, True), False), "links")
        now = seen(edges)
        delete()  # the round before is read no more
        delete = delete_next
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
