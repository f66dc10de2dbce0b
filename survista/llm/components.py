"""Connected components by alternating large-star and small-star joins.

The edges stay in Spark. A node's neighbours are never gathered: the smallest is a partial aggregate, and it
goes back to the edges by a join, which AQE can split when one node has very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from survista.llm.common import materialise


def _large_star(e: DataFrame) -> DataFrame:
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u != v").distinct())


def _small_star(e: DataFrame) -> DataFrame:
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()


def _state(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(u, v) edges of any one orderable type to (node, label), label the smallest node reachable.

    Nodes without an edge, and edges with a null end, are not in the result. Repeated edges, both directions and
    loops are allowed; no edges give no rows. The driver sees only a count and a checksum of each round.
    """
    e = materialise(edges.select("u", "v").filter("u != v").distinct(), "edges")
    before = _state(e)
    while before[0]:
        e = materialise(_small_star(_large_star(e)), "edges")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
