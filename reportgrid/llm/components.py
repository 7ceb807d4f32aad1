"""Connected components of a graph whose edges are rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportgrid.sources.staging import staged


def components(edges: DataFrame) -> DataFrame:
    """For each node of ``edges`` (``a``, ``b``): ``node`` and ``root``, the least node that can be reached.

    Large-star and small-star steps in turns: every node is linked to the least of its neighbours until
    nothing moves. The number of rounds grows with the logarithm of the number of nodes, the edges never
    get more. Each round is written, so a lost executor costs nothing. A node that an edge joins to itself only is its own root.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    alone = edges.filter("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    links = edges.filter("a <> b")
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # large star: neighbours above a node move to the least of it and its neighbours
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        large = both.filter("b > a").join(low, "a").select(F.col("low").alias("a"), F.col("b")).distinct()
        # small star: the node and its lower neighbours move to the least of these
        under = large.groupBy("b").agg(F.min("a").alias("low"))
        joined = large.join(under, "b")
        small = joined.select(F.col("low").alias("a"), "b").unionByName(
            joined.filter("a <> low").select(F.col("low").alias("a"), F.col("a").alias("b"))
        )
        after = staged(small.distinct())
        moved = after.join(links, ["a", "b"], "left_anti").limit(1).count()
        same = not moved and after.count() == links.count()
        links = after
        if same:
            break
    roots = links.select(F.col("b").alias("node"), F.col("a").alias("root"))
    tops = links.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct()
    own = alone.join(roots.unionByName(tops).select("node"), "node", "left_anti")
    return roots.unionByName(tops).unionByName(own)
