"""Connected components by alternating large and small stars, in Spark joins.

Edges are (a, b) rows of one type with an order. Each round hooks every node onto the smallest
neighbour it knows. Minima are partial aggregates, and are stored before the edges are joined with them:
a hub of any degree never gathers in a task, as adaptive execution can split a join of two plain tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perimetry.plans.storage import discard, scratch_path


class _Round:
    """Tables of one round, deleted once the next edges are stored."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def saved(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "components")
        df.write.parquet(path)
        self.paths.append(path)
        return self.spark.read.parquet(path)

    def discard(self) -> None:
        for path in self.paths:
            discard(self.spark, path)


def _large_star(edges: DataFrame, tables: _Round) -> DataFrame:
    """Every neighbour above a node moves to the smallest of the node and its neighbours. Edges run downwards."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = tables.saved(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    return edges.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame, tables: _Round) -> DataFrame:
    """Every neighbour below a node, and the node, move to the smallest of them. Edges run downwards."""
    least = tables.saved(edges.groupBy("a").agg(F.min("b").alias("m")))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge; ``component`` is the smallest node reachable.

    Null ends and loops link nothing; repeated edges and both directions are harmless; no edges give
    no rows. Each round is a table in the shared folder, which replaces the one before.
    """
    spark = edges.sparkSession
    a, b = edges.columns[:2]
    edges = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    tables = _Round(spark)
    current = tables.saved(edges.distinct())
    mark = None
    while True:
        following = _Round(spark)
        larger = following.saved(_large_star(current, following))
        moved = _Round(spark)
        current = moved.saved(_small_star(larger, following))
        tables.discard()
        following.discard()
        tables = moved
        # at the fixed point every node hangs on its root and the set of edges stays as it is
        now = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("long"))).first()
        if now == mark or now[0] == 0:
            break
        mark = now
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
