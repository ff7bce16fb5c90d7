"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from itemwise.llm.common import stage


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return r[0], r[1]


def components(edges: DataFrame) -> DataFrame:
    """node and root (the smallest node it is connected with) of every node
    that has an edge; ``edges`` has two long columns.

    Alternating star contraction: each round hangs a node's neighbours below
    its smallest neighbour, first the larger ones, then the smaller. Edges
    stay as many as nodes. A hub's smallest neighbour is a map-side minimum,
    written before it is joined back, so Spark can split a hub's rows.
    """
    a, b = edges.columns
    now = stage(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges").df
    before, at = None, _state(now)
    while at[0] and at != before:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stage(both.groupBy("u").agg(F.min("v").alias("m"))
                    .select("u", F.least("u", "m").alias("m")), "stars").df
        large = stage(both.join(low, "u").where("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges").df
        low = stage(large.groupBy("u").agg(F.min("v").alias("m")), "stars").df
        small = large.join(low, "u").where("v <> m").select(
            F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            low.select("u", F.col("m").alias("v")))
        now = stage(small.distinct(), "edges").df
        before, at = at, _state(now)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
