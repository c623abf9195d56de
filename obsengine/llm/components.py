"""Connected components of a distributed edge list.

Alternating large-star and small-star rounds: every node keeps edges only to the
smallest node it has seen, until the edges form stars.  Each round is two
aggregations and joins over the edges; the edges are written to the shared
folder in between.  A hub's edges are combined before the shuffle, and the joins
are plain ones that adaptive execution splits.  Only counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsengine.llm.common import written

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: connect strictly larger neighbours to the smallest one.
    Small: connect the node and its smaller neighbours to the smallest one."""
    if large:
        edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        moved = edges.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return moved.where("a <> b")
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``, any order);
    ``root`` is the smallest node reachable.  Loops, doubles and nulls are ignored."""
    directed = (edges.where("a <> b")
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    current = written(directed, name)
    before = None
    for _ in range(MAX_ROUNDS):
        large = _star(current, True).select(F.greatest("a", "b").alias("a"),
                                            F.least("a", "b").alias("b")).distinct()
        current = written(_star(written(large, name), False).distinct(), name)
        # Stars are a fixed point; equal row hashes of two rounds show it.
        now = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
