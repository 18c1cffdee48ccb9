"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """Each node's least neighbour, itself included; partial sums meet, no list does."""
    return pairs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours above a node hang on the node's least neighbour."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    above = both.where("b > a")
    return above.join(_least(both), "a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its neighbours below hang on the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    joined = down.join(_least(down), "a")
    return joined.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b")


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node of its component) for all nodes with a link.

    ``edges`` has two columns ``a`` and ``b`` of one ordered type. Each round is
    written to the shared folder; rounds grow with the logarithm of the nodes.
    A node with very many links is spread by the adaptive skew join: its least
    neighbour is one row on the other side.
    """
    now = materialize(edges.where("a <> b").select("a", "b").distinct(), "links")
    mark = None
    while True:
        now = materialize(_small_star(_large_star(now)).distinct(), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = state
