"""Connected components of an edge table by alternating large and small stars.

Every round is a handful of joins and groupings; a node with very many neighbours is one hot join key, which adaptive
execution splits. Edge tables are written to the shared folder after each round, so a lost executor costs a re-read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lodestrata.storage import materialise, release


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, itself included."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (u, v: long) -> (node, component): the smallest node reachable, for every node of an edge.

    Loops and repeated edges are ignored, edges with a null end too. An empty table gives an empty table.
    """
    now = materialise(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Large star: neighbours above a node move to its lowest neighbour.
        large = both.join(_lowest(both), "u").where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))) \
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the node and its lower neighbours move to the lowest of them.
        low = _lowest(large)
        then = materialise(
            large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v")).distinct(), "edges")
        seal = [F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
        same = now.agg(*seal).first() == then.agg(*seal).first()
        release(now)
        if same:
            break
        now = then
    stars = then.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(then.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
