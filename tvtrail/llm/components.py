"""Connected components of a graph held as an edge table.

Alternates large-star and small-star steps (Kiveris et al., "Connected Components in
MapReduce and Beyond"): each step hangs a node's neighbours on their smallest one,
until every component is a star around its smallest node.  Steps are one aggregation
and one join over edges; nothing but two counters comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tvtrail.llm.common import discard, settle


def _smallest(edges: DataFrame) -> DataFrame:
    """Settled, so that the join with the edges can split those of a hub."""
    return settle(edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low")), "smallest")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = _smallest(both)
    hung = both.where(F.col("b") > F.col("a")).join(low, "a")
    out = settle(hung.select(F.col("b").alias("a"), F.col("low").alias("b")).distinct(), "edges")
    discard(low)
    return out


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = _smallest(down)
    hung = down.join(low, "a").where(F.col("b") != F.col("low")).select(F.col("b").alias("a"), F.col("low").alias("b"))
    out = settle(hung.unionByName(low.select("a", F.col("low").alias("b"))).where("a <> b").distinct(), "edges")
    discard(low)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(a, b) edges between ids -> settled (node, component) for every node that has an edge.

    ``component`` is the smallest id reachable.  Loops and repeated edges do no harm.
    """
    ids = edges.where("a <> b").select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).distinct()
    now = settle(ids, "edges")
    seen = None
    while True:
        larger = _large_star(now)
        following = _small_star(larger)
        discard(larger)
        mark = tuple(following.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        discard(now)
        now = following
        if mark == seen or not mark[0]:
            break
        seen = mark
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
