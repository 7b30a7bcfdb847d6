"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyvault.llm.shared import keep


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of the edges (a, b): the smallest id that links reach.

    Each round connects larger neighbours to the smallest one, first from every vertex outwards and
    then inwards; the number of rounds grows with the logarithm of the longest path. A hub's edges
    meet their smallest neighbour by a join, which Spark can split, and minima fold before a shuffle.
    """
    e = keep(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = keep(small.unionByName(joined.select("u", F.col("m").alias("v"))).distinct())
        after = _state(e)
        if after == before:
            break
        before = after
    ends = e.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.unionByName(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
