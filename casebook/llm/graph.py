"""Connected components of an edge table, by alternating large and small stars; nothing of them comes to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import discard, materialise

#: Rounds before giving up; paths shrink exponentially, so this is never met.
MOST = 60


def _min_of(neighbours: DataFrame) -> DataFrame:
    """u, m: least of u and its neighbours. Summed on the map side, so a hub is no hot key."""
    return neighbours.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """Edges a, b (longs) to node, comp: each node's least reachable node. Nodes that are their own least have no row."""
    now = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    before = None
    for _ in range(MOST):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_min_of(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        last, now = now, materialise(small)
        discard(last)
        after = tuple(now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if after == before or not after[0]:
            break
        before = after
    else:
        raise RuntimeError("components did not converge")
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
