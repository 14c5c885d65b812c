"""Connected components of links by star contraction."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlake.llm.common import stored


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one smaller node that hangs on none."""
    leaves = edges.groupBy("a").agg(F.count("*").alias("n"), F.min(F.col("b") < F.col("a")).alias("ok"))
    if not leaves.filter("n > 1 OR NOT ok").isEmpty():
        return False
    return edges.select(F.col("b").alias("a")).join(leaves, "a", "left_semi").isEmpty()


def connected(edges: DataFrame) -> DataFrame:
    """(node, component) for all nodes of links (a, b): the smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, on its
    smallest neighbour. Minima are grouped with partial sums, and a node with very
    many links is one row on one side of a join that Spark can split. Rounds are
    stored, so nothing depends on one executor.
    """
    edges = stored(edges.select("a", "b").filter("a <> b").distinct(), "links")
    while not _is_stars(edges):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select("a", F.least("a", "least").alias("least"))
        large = (
            both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("least").alias("b"))
            .filter("a <> b").distinct()
        )
        down = stored(
            large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "large"
        )
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = (
            down.join(least, "a")
            .select(F.explode(F.array(F.struct("a", "least"), F.struct(F.col("b").alias("a"), "least"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.least").alias("b"))
            .filter("a <> b").distinct()
        )
        edges = stored(small, "small")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component"))
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.unionByName(roots).distinct()
