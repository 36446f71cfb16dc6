"""Connected components of an undirected edge table, as DataFrame rounds.

Alternating large-star and small-star steps: every round is two aggregates and two
joins over the edges, and the number of rounds grows with the logarithm of the longest
chain.  Edges and labels stay distributed; only two numbers per round reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerguard.llm.common import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    both = _both_ways(edges)
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``edges`` (u long, v long) -> (node, root) for every node of an edge, where root is
    the smallest node of its component.  Loops and repeated edges are harmless; an empty
    table gives an empty table; an edge with a null end is ignored."""
    cur = cut_lineage(edges.where("u is not null and v is not null and u <> v")
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = None
    for _ in range(max_rounds):
        now = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen or now[0] == 0:
            break
        seen = now
        cur = cut_lineage(_small_star(_large_star(cur)))
    else:
        raise RuntimeError("components did not settle")
    pairs = cur.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
