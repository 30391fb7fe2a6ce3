"""Connected components of an edge table, by alternating large-star and
small-star steps.

Each step replaces every node's links by links to the least node it sees, so
trees flatten in a logarithmic number of rounds. A step is one grouped minimum
(pre-aggregated before the shuffle) and one join; a hub with very many links
is split by the skew handling of adaptive joins, as only its own side is long.
Edges are checkpointed in every round; nothing but counts reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import cut


def _star(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): the least of u and its partners."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 100) -> DataFrame:
    """``node`` and ``component`` (its least node) for every node that has an
    edge to another; nodes are of any ordered type. Null ends and loops are
    ignored. The rounds grow with the logarithm of the longest path, so
    ``max_rounds`` is out of reach of any table; it ends a loop that a wrong
    edge type could cause."""
    e = cut(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
            .filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
            .distinct())
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        # large star: larger partners are linked to the least one seen
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: a node and its smaller partners are linked to the least
        small = _star(large)
        new = cut(small.select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .unionByName(small.select("u", F.col("m").alias("v")))
                  .filter("u <> v").distinct())
        # done when the edges are stars: no node has two partners, none is
        # both a leaf and a centre
        centres = new.select(F.col("v").alias("u")).distinct()
        nodes, links = new.agg(F.countDistinct("u"), F.count(F.lit(1))).first()
        e = new
        if nodes == links and new.join(centres, "u", "left_semi").isEmpty():
            leaves = new.select(F.col("u").alias("node"), F.col("v").alias("component"))
            return leaves.unionByName(centres.select(
                F.col("u").alias("node"), F.col("u").alias("component")))
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
