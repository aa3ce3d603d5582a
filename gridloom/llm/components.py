"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import discard, join_counted, stored


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b), longs: node and root, the least node of its component. Nodes without edges are not listed.

    Each round is two equi-joins with grouped minima; nothing gathers the neighbours of a node, and the minima of nodes
    with very many neighbours are broadcast, so that these don't lie in one task. Every round's edges are
    written to the shared folder, so that plans stay short and lost executors cost one round at most.
    """
    now = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"), F.sum((F.col("v") > F.col("u")).cast("long")).alias("n"))
        least = stored(least.filter("n > 0"), "least")
        # u is the greater end of every edge: turned round, each is one of the edges to greater neighbours
        large = join_counted(now.select(F.col("v").alias("u"), F.col("u").alias("v")), least, ["u"], now.count()).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(root, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(root.select("u", F.col("m").alias("v")))
        last, now = now, stored(small.distinct(), "edges")
        discard(last)
        discard(least)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.shiftright(F.xxhash64("u", "v"), 16))).first()
        if mark == seen:
            break
        seen = mark
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
