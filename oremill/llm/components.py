"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oremill.llm.common import stored


def components(edges: DataFrame, label: str) -> DataFrame:
    """``node`` and ``root``, the smallest node that links reach, for the nodes of ``edges`` (columns ``a`` and ``b``) that
    are not roots themselves.

    Alternates the large-star and the small-star step: first every node links its larger neighbours to the smallest of
    its neighbourhood, then its smaller ones, until all edges point at roots.  That takes about as many rounds as the
    logarithm of the longest path.  The smallest neighbour is aggregated before the shuffle and stored, so that the join has
    shuffles of its own, in which Spark splits a node of very many links, or none if few nodes are left; nothing comes to the
    driver but a count.  Nodes may be of any type with an order.  Null nodes and links of a node to itself are
    left out.
    """
    a, b, root = F.col("a"), F.col("b"), F.col("root")
    now = stored(edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), f"{label}-edges")
    while True:
        both = now.select("a", "b").unionAll(now.select(b.alias("a"), a.alias("b")))
        least = stored(both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("root")), f"{label}-least")
        # One link for each there was: links that became equal need not be found here.
        large = stored(both.join(least, "a").where(b > a).select(b.alias("a"), root.alias("b")), f"{label}-large")
        low = stored(large.groupBy("a").agg(F.min("b").alias("root")), f"{label}-low")
        small = large.join(low, "a").where(b != root).select(b.alias("a"), root.alias("b"))
        now = stored(small.unionAll(low.select("a", root.alias("b"))).distinct(), f"{label}-edges")
        if _settled(now):
            return now.select(a.alias("node"), b.alias("root"))


def _settled(edges: DataFrame) -> bool:
    """Whether all different edges, which lead to smaller nodes, point at roots: no node has two edges or is pointed at and has one."""
    up, down = F.lit(1).alias("up"), F.lit(1).alias("down")
    ends = edges.select(F.col("a").alias("node"), up, F.lit(0).alias("down")).unionAll(edges.select(F.col("b").alias("node"), F.lit(0).alias("up"), down))
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not each.where(F.col("up") + F.col("down") > 1).count()
