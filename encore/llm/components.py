"""Connected components by alternating large-star and small-star rounds.

Each round rewires every edge towards the smallest neighbour of its end
(Kiveris et al., "Connected Components in MapReduce and Beyond", 2014) and
ends in stars: one edge from each node to the smallest node of its
component. Minima are pre-aggregated before the shuffle and come back by a
join whose small side has one row per node, so a hub's edges can be split
over tasks (AQE) and no adjacency list is ever built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
    up = edges.select(F.col("u").alias("hi"), F.col("v").alias("lo"))
    # of the pairs (centre, larger neighbour) only (lo, hi) qualifies
    return up.join(low, up["lo"] == low["c"]).select(F.col("hi").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
    moved = edges.join(low, edges["u"] == low["c"]).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select(F.col("c").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``u, v``, any direction).

    ``root`` is the smallest node of the component. Self loops and nulls are
    ignored; no edges give no rows.
    """
    flat = edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, state = stored(flat, "edges"), None
    while True:
        row = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not row[0]:
            break
        if state == tuple(row):
            break
        state = tuple(row)
        now = stored(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
