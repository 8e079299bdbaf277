"""Connected components of a graph in a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import kept


def _settled(edges: DataFrame) -> bool:
    """Whether every node points at one other, and that one at none."""
    onward = edges.join(edges.select(F.col("u").alias("v")), "v", "left_semi")
    return onward.isEmpty() and edges.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``links`` (a, b).

    Large-star and small-star steps alternate until nothing changes, in a number of rounds that
    grows with the logarithm of the longest path. A neighbourhood's minimum is a partial
    aggregate joined back, so the many neighbours of a hub are never gathered in one task.
    Null ends and links of a node with itself are dropped.
    """
    edges = kept(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not _settled(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = kept(small.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct(), "edges")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct()
