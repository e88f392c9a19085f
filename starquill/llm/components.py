"""Connected components of a distributed graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starquill.session import materialise


def _state(edges: DataFrame) -> tuple:
    """A fingerprint of the edges: three numbers, however many edges."""
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 31)))).first())


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (the least node reachable) of every node that has an edge.

    Large-star and small-star steps in turn, until the edges are stars around the least nodes;
    the number of rounds grows with the logarithm of the longest path.  Each step is one
    aggregation, pre-summed in the tasks, and one inner join; each round is written out.
    """
    edges = materialise(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .filter("u > v").distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = (both.filter("v > u").join(least, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").filter("v > m").select(F.col("v").alias("u"),
                                                               F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct())
        edges = materialise(small, "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
