"""Connected components of a graph of longs, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import freeing_shuffles
from starmart.sources.scratch import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``): root is its component's least node.

    Two steps alternate.  In the first each node hands its least neighbour to its larger
    neighbours, in the second to its smaller ones and itself; both keep the components as
    they are, and stars are left after a number of rounds that grows with the logarithm of
    the longest path.  The least neighbour is a grouped minimum, combined before the
    shuffle, so a node with very many edges makes no large group; it is written before it is
    joined, so that the join is one of two plain tables, which adaptive execution can split.
    Each round is written to the shared scratch folder, which cuts the lineage.
    """
    spark = edges.sparkSession
    with freeing_shuffles(spark):
        links = stored(_downward(edges), "edges")
        before = None
        while True:
            links = stored(_small_star(_large_star(links)), "edges")
            now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
            if tuple(now) == before:
                break
            before = tuple(now)
    roots = links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def _downward(edges: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _least(links: DataFrame) -> DataFrame:
    return stored(links.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "least")


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's least neighbour or itself."""
    least = _least(links)
    moved = links.join(least, links["b"] == least["node"], "left")
    return moved.select("a", F.coalesce("least", "b").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of them."""
    least = _least(links)
    others = links.join(least, links["a"] == least["node"]).where(F.col("b") != F.col("least"))
    return least.select(F.col("node").alias("a"), F.col("least").alias("b")).unionByName(others.select(F.col("b").alias("a"), F.col("least").alias("b"))).distinct()
