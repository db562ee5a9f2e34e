"""Connected components of a graph in DataFrames (alternating star contraction).

Each round hangs larger neighbours on the smallest one (large star), then
smaller ones (small star); the number of rounds grows with the logarithm of
the longest path.  Edges are written to the shared folder after each round, so
that no lineage builds up and lost executors cost one round at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devicegrid.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction of distinct edges (a, b), a > b."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("__a"), F.least("a", "m").alias("m"))
    met = both.join(least, F.col("a") == F.col("__a"))
    if large:
        out = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select(F.col("__a").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") > F.col("b")).distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b); label: its component's smallest node."""
    edges = written(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    for _ in range(max_rounds):
        edges = written(_star(_star(edges, True), False), "edges")
        seen = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen.n, seen.h) == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        mark = (seen.n, seen.h)
    raise RuntimeError("the components did not settle")
