"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.common import intermediate, staged


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Tie neighbours to the smallest one: those above a node (large star), or those below and the node itself (small star).

    `links` has one row (low, high) with low < high per link. The smallest neighbour is a partial aggregate;
    a node with very many links only meets them in a join, which Spark can split.
    """
    up, down = links.select(F.col("high").alias("node"), F.col("low").alias("near")), None
    if large:
        down = links.select(F.col("low").alias("node"), F.col("high").alias("near"))
        smallest = up.union(down).groupBy("node").agg(F.least(F.min("near"), F.first("node")).alias("root"))
        tied = down.join(smallest, "node").select(F.col("root"), F.col("near").alias("leaf"))
    else:
        smallest = up.groupBy("node").agg(F.min("near").alias("root"))
        tied = up.join(smallest, "node").select("root", F.col("near").alias("leaf"))
        tied = tied.union(smallest.select("root", F.col("node").alias("leaf")))
    return tied.where("root <> leaf").distinct().select(F.col("root").alias("low"), F.col("leaf").alias("high"))


def _state(links: DataFrame) -> tuple:
    """Number of links and an order-free digest of them."""
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("low", "high"))).first())


def components(links: DataFrame) -> DataFrame:
    """`(node, component)` for every node of `links (low, high)`; a component is named by its smallest node.

    Alternating large and small stars until nothing changes. Every round is written to shared scratch, so
    lineage stays short. A null on either side and loops are no links; repeated links count once.
    """
    spark = links.sparkSession
    ordered = links.where("low <> high").select(F.least("low", "high").alias("low"), F.greatest("low", "high").alias("high"))
    with intermediate(spark) as keep:
        links = staged(ordered.distinct(), "links")
        state = _state(links)
        while True:
            with intermediate(spark) as keep_round:
                links = keep_round(_stars(staged(_stars(links, large=True), "links"), large=False), "links")
            after = _state(links)
            if after == state:
                break
            state = after
        roots = links.select(F.col("high").alias("node"), F.col("low").alias("component"))
        return keep(roots.union(links.select(F.col("low").alias("node"), F.col("low").alias("component")).distinct()), "components")
