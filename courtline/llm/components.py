"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm.common import look_up, written


def _to_smallest(pairs: DataFrame, total: int) -> DataFrame:
    """``pairs`` (u, v) with ``m``, the smallest of u and all its v."""
    smallest = pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    return look_up(pairs, smallest, "u", ["m"], "n", total, F.col("v"))


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) of every node that an edge (u, v) of longs touches.

    Rounds of the large-star and small-star steps of Kiveris et al. (2014), each
    a pre-aggregated minimum by node and a look-up that splits hot nodes, written
    to the shared folder.  Self loops and repeated edges do no harm; no edges, no
    rows.  The number of rounds grows with the logarithm of the longest chain.
    """
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .filter("u <> v").distinct(), "edges")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _to_smallest(both, 2 * state[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.filter("u <> v").distinct(), "large-star")
        pointed = _to_smallest(large, max(1, large.count()))
        small = pointed.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            pointed.select("u", F.col("m").alias("v"))).filter("u <> v")
        edges = written(small.distinct(), "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.groupBy("u").agg(F.min("v").alias("v"))
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
