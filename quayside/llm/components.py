"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a minimum per node (combined before the shuffle) joined back to the edges. Nodes with very many neighbours are
few; their minima are broadcast, and their edges go through the join under keys of their own, so that no task gets all edges
of a node. The number of steps grows with the logarithm of the component sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import cut

#: A node is a hub if it has one in so many of all edge ends; there are at most so many hubs.
HUB_SHARE = 1 << 12
#: Nodes of fewer neighbours are no hubs.
HUB_LEAST = 64


def _with_min(edges: DataFrame, ends: int) -> DataFrame:
    """(u, v, m) for distinct edges, of which there are at most `ends`: m is the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    many = max(HUB_LEAST, ends // HUB_SHARE)
    hubs = F.broadcast(least.filter(F.col("n") >= many).select(F.col("u").alias("hub"), F.col("m").alias("hub_m")))
    others = least.filter(F.col("n") < many).select(F.col("u").alias("u_"), F.col("m").alias("m_"))
    at = edges.join(hubs, F.col("u") == F.col("hub"), "left").withColumn("k", F.when(F.col("hub").isNull(), F.col("u")).otherwise(F.xxhash64("u", "v")))
    m = F.when(F.col("hub").isNull(), F.col("m_")).otherwise(F.col("hub_m"))
    return at.join(others, F.col("k") == F.col("u_"), "left").select("u", "v", F.least(F.col("u"), m).alias("m"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_min(both, 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _with_min(down, n)
    return starred.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(starred.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node on an edge; component is the smallest node reachable.

    Self-loops and edges with a null end are ignored, repeated and reversed edges count once; an empty table gives an empty
    result; other columns are ignored.
    """
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"), F.col(a).isNotNull().alias("x"), F.col(b).isNotNull().alias("y"))
    e = cut(e.filter("x AND y AND u <> v").select("u", "v").distinct())
    n, before = e.count(), None
    while n:
        e = cut(_small_star(cut(_large_star(e, n)), n))
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        n = now[0]
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
