"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlake.llm.tables import Scratch


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b); the root is the component's least node.

    Nodes are hung alternately under the least of all their neighbours and under the
    least of their smaller ones, until nothing changes; the number of rounds grows with
    the logarithm of the longest path. Minima are partial aggregates, so a node with many
    neighbours is no single task.
    """
    edges = scratch.write(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{name}-0")
    state, step = _state(edges), 0
    while state[0]:
        step += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Minima are written: a join of two plain scans is one whose large keys Spark can split.
        low = scratch.write(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{name}-low")
        hung = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        hung = scratch.write(hung, f"{name}-hung")
        least = scratch.write(hung.groupBy("a").agg(F.min("b").alias("m")), f"{name}-least")
        tied = hung.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        flat = tied.unionByName(least.withColumnRenamed("m", "b"))
        edges = scratch.write(flat.filter("a <> b").distinct(), f"{name}-{step}")
        scratch.drop(f"{name}-{step - 1}", f"{name}-low", f"{name}-hung", f"{name}-least")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
