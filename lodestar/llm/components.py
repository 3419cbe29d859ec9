"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import stage
from lodestar.operators.skew import salted_key_join


BROADCAST_LINKS = 500_000  # rows of 24 bytes; the stars of more links are joined by shuffle


def _with_least(links: DataFrame, least: DataFrame, small: bool) -> DataFrame:
    """``links(u, v)`` with the least neighbour ``m`` of ``u``; ``least`` has a row per node."""
    if small:
        return links.join(F.broadcast(least), "u")
    return salted_key_join(links, least, "u", "size", spread_col="v")


def components(links: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``links(a, b)``; the label is the least node.

    Each round links a node's larger neighbours (large star), then its smaller ones (small
    star) to the least of them, until no link changes.  The rounds grow with the logarithm of
    the diameter, links never outgrow the input, and each round is written to the shared
    folder.  Self links and repeated links do no harm.
    """
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .where("u > v").distinct(), "links")
    # equal link sets have equal counts and sums
    mark = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    state = edges.agg(*mark).first()
    while True:
        small = 2 * state[0] <= BROADCAST_LINKS
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size")).select(
            "u", F.least("u", "m").alias("m"), "size")
        large = (_with_least(both, least, small).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("size"))
        edges = stage(_with_least(large, low, small)
                      .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
                      .where("u > v").distinct(), "links")
        before, state = state, edges.agg(*mark).first()
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
