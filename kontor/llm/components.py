"""Connected components of a large edge table by alternating star contractions.

Each round points every node's larger neighbours at its smallest one (large
star), then every node and its smaller neighbours at the smallest of them
(small star).  Both keep the components and strictly lower some edge until the
table is a forest of stars, each around the smallest node of its component.
A hub's edges meet its minimum only through a partial aggregation and a join
that adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _star(directed: DataFrame, small: bool) -> DataFrame:
    """Edges (u, v) read from u; the neighbours to move are those above u (large) or below (small)."""
    own = F.col("u")
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    joined = directed.join(least, "u")
    if small:
        moved = joined.select(F.col("v").alias("x"), "m").unionByName(least.select(F.col("u").alias("x"), "m"))
    else:
        moved = joined.filter(F.col("v") > own).select(F.col("v").alias("x"), "m")
    return moved.filter("x <> m").select(F.col("x").alias("u"), F.col("m").alias("v")).distinct()


def component_roots(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node with an edge to another; root is the smallest node reachable."""
    current = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
                     "edges")

    def summary(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = summary(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = stored(_star(both, small=False), "large_star")
        current = stored(_star(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), small=True),
                         "small_star")
        after = summary(current)
        if tuple(after) == tuple(before):
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))
