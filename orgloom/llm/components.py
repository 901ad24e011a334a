"""Connected components by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orgloom.session import cut


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` of every node with an edge to another; the component is its smallest node.

    Edges may repeat, run both ways or be loops; edges with a null end are
    left out. Each round first hangs every greater neighbour, then every smaller one,
    on a node's smallest neighbour, until all hang on the smallest; the number of rounds
    grows with the logarithm of the longest path. Neighbours are never gathered
    in one place: a node's smallest neighbour is a minimum, joined back. Rounds
    are written to the shared folder.
    """
    step = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    step = cut(step.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while True:
        both = step.unionByName(step.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        step = cut(small.filter("u <> v").distinct())
        # every node hangs on one that hangs on none, and on no other: nothing can move any more
        ends = step.select(F.col("u").alias("x"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(step.select(F.col("v").alias("x"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
        if ends.groupBy("x").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds")).filter("hangs > 1 or (hangs > 0 and holds > 0)").isEmpty():
            break
    members = step.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(members.select(F.col("component").alias("node"), "component").distinct())
