"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.sources.workspace import persisted


def _towards_minimum(edges: DataFrame, keep: str) -> DataFrame:
    """One star step: the neighbours of each node on one side are tied to its smallest neighbour.

    The minimum is a partial aggregate and the neighbours are joined to it, so no node's neighbours meet in
    one group, and a join on a hot node can be split.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if keep == "larger" else both.where("b < a")
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    tied = side.join(least, "a")
    if keep == "larger":
        return tied.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    own = least.select("a", F.col("m").alias("b"))
    return tied.select(F.col("b").alias("a"), F.col("m").alias("b")).union(own).where("a <> b").distinct()


def component_labels(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of a link between two different nodes; component is its smallest node.

    Alternates large-star and small-star steps until each node is tied to its component's minimum. Every
    round is a written table, so the plan stays short and lost executors cost one round.
    """
    ordered = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b").distinct()
    edges = persisted(ordered, "component_edges", shuffle=False)
    while not _stars(edges):
        edges = persisted(_towards_minimum(_towards_minimum(edges, "larger"), "smaller"), "component_edges", shuffle=False)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """True if every node has one smaller neighbour, which has none itself: the neighbour is then its component's smallest node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not nodes.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).agg(F.count("*")).first()[0]
