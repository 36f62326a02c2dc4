"""Connected components of an edge table, in passes that each end in a written table.

Alternating large-star and small-star passes: in a large-star pass every node's larger
neighbours are linked to its smallest neighbour, in a small-star pass its smaller
neighbours are.  A pass is one map-side combined minimum per node and one join; no
neighbour list is ever gathered.  A node with very many links only makes one side of the
join skewed, which adaptive execution splits.  Passes repeat until nothing changes; the
number grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordlens.llm.common import scratch

#: Far above what any graph needs that fits a cluster; a guard against a fault here.
MOST_PASSES = 60


def _smallest(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of an
    edge table (``a``, ``b``: any integers)."""
    links = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct()
    links = scratch(links, "links")
    before = None
    for _ in range(MOST_PASSES):
        # large star: neighbours above u go to the smallest of u and its neighbours
        around = _both(links)
        large = around.join(_smallest(around).withColumnRenamed("u", "w"), F.col("u") == F.col("w")).where("v > u").select(
            F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # small star: u and its neighbours below go to the smallest of them
        below = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        least = below.groupBy("u").agg(F.min("v").alias("m"))
        moved = below.join(least.withColumnRenamed("u", "w"), F.col("u") == F.col("w")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        links = scratch(moved.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a != b").distinct(), "links")
        # unchanged: the same number of links and the same sum over them
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def local_roots(a, b, n: int):
    """Smallest member of each node's component, for edges between 0 .. n-1 (numpy)."""
    import numpy as np

    root = np.arange(n)
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        # only roots are hooked, the larger under the smaller, so that whole trees move
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (root[root] != root).any():
            root = root[root]
