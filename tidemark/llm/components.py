"""Connected components by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored

_ROUNDS = 60


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One contraction of edges (a, b) towards the smallest neighbour of each node.

    ``large``: every larger neighbour of a node is tied to the smallest one (or the node itself).
    Otherwise the smaller neighbours and the node itself are.
    """
    if large:
        both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    if not large:
        tied = both.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        tied = tied.unionByName(least.select("a", F.col("m").alias("b")))
    else:
        tied = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.filter("a <> b").distinct()


def smallest_reachable(spark: SparkSession, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes`` (f, least) with ``least`` lowered to the smallest of its component, and ``hub``, which tells components apart.

    ``edges`` are pairs (a, b) of ``f``. Each round is cut by a written table. The stars shrink the
    depth of a tree to a fraction, so the number of rounds grows with the logarithm of the longest
    chain; a hub's row for a neighbour is a plain join row, which adaptive execution can split.
    """
    now = stored(edges.select("a", "b").filter("a <> b").distinct(), "edges")
    before = None
    for _ in range(_ROUNDS):
        now = stored(_star(_star(now, True), False), "stars")
        state = tuple(now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("the components did not settle")
    # Now each node points at the smallest node of its component.
    member = nodes.join(now, nodes["f"] == now["a"], "left").select(
        "f", "least", F.coalesce("b", "f").alias("hub")
    )
    lowest = member.groupBy("hub").agg(F.min("least").alias("least"))
    return member.select("f", "hub").join(lowest, "hub").select("f", "least", "hub")
