"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillframe.llm.common import staged


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    return row[0], row[1] or 0


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has an edge. Each round is staged.

    Both steps keep components and shorten paths; the number of rounds grows with the logarithm of the longest path.
    Minima are summed before they are shuffled, so a node with very many edges is no single task's work.
    """
    high, low = F.greatest(a, b), F.least(a, b)
    now = staged(edges.where(F.col(a) != F.col(b)).select(high.alias("u"), low.alias("v")).distinct(), "edges")
    before, state = None, _state(now)
    for _ in range(max_rounds):
        if state == before or not state[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
