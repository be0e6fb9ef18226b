"""Connected components of an edge table, by alternating stars over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postings.llm.common import stored

MAX_ROUNDS = 60


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least node around it."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``u``, ``v``, non-null, comparable); root: the least node reachable.

    Neighbour lists are never gathered: the least neighbour is a combined minimum and edges are moved
    by a join, so a hub costs no task more than its share. Each round is written to the shared folder.
    """
    now = stored(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        after = stored(_small_star(_large_star(now)).filter("u <> v").distinct(), "edges")
        seen = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            return after.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(after.select("v", "v").distinct())
        now, mark = after, seen
    raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
