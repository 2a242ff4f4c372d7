"""Connected components of a graph given as edges, by alternating star contractions.

Large-star links every larger neighbour of a node to the least node around it,
small-star links the smaller neighbours. Each is one minimum per node (combined on the
map side) and one join with it, so no neighbourhood is ever gathered in a task. The
edges of each round are a written table; rounds grow with the logarithm of the nodes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sparkrec.session import durable


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge to another: root is the least node it reaches.

    edges: (u, v) longs, any direction, repeats and loops allowed. Roots themselves have no row.
    """
    high, low = F.greatest("u", "v"), F.least("u", "v")
    now = durable(edges.filter("u <> v").select(high.alias("u"), low.alias("v")).distinct())
    state = _summary(now)
    while True:
        now = durable(_small_star(_large_star(now)))
        before, state = state, _summary(now)
        if before == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _summary(edges: DataFrame) -> tuple:
    """Count and two sums over hashes: equal only for equal sets, but for a 2**-64 chance."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 16)), F.bit_xor(h)).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
