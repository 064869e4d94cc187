"""Connected components of a graph given as pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import saved

MAX_ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(20)")).alias("s")
    ).first()
    return row["n"], int(row["s"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` of all nodes in ``edges`` (longs ``a, b``): component is its smallest node.

    Large-star and small-star rounds alternate until nothing changes, after a number of rounds that
    grows with the logarithm of the nodes. A round aggregates map-side and joins compact rows; the
    star of a hot node is split by adaptive execution. Each round is written to the shared folder.
    """
    edges = saved(
        edges.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = _state(edges)
    for _ in range(MAX_ROUNDS):
        if before[0] == 0:
            break
        # Large star: larger neighbours of a node move to the smallest node around it.
        around = _both_ways(edges)
        least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = around.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        large = large.distinct()
        # Small star: a node and its smaller neighbours move to the smallest of them.
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a").filter(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = saved(moved.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "edges")
        after = _state(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"no components after {MAX_ROUNDS} rounds")
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    own = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.unionByName(own)
