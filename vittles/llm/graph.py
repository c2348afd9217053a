"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vittles.llm.common import observed

#: edges that one task of a round takes, about
TASK_ROWS = 50_000


def _stars(pairs: DataFrame, large: bool, tasks: int) -> DataFrame:
    """Edges (u, v) by node, its least neighbour first and repeated edges once.

    Large: every larger neighbour is linked to the least of the node and its
    neighbours. Small, of edges to smaller nodes: the node and its neighbours are linked
    to the least of these. The windows are evaluated by so many tasks at most.
    """
    by_node = Window.partitionBy("u").orderBy("v")
    seen = pairs.select("u", "v", F.first("v").over(by_node).alias("low"), F.lag("v").over(by_node).alias("last")).coalesce(tasks)
    seen = seen.where(F.col("last").isNull() | (F.col("last") != F.col("v")))
    if large:
        return seen.where("v > u").select(F.col("v").alias("a"), F.least("u", "low").alias("b"))
    # the row of the least neighbour stands for the node itself
    return seen.select(F.when(F.col("v") == F.col("low"), F.col("u")).otherwise(F.col("v")).alias("a"), F.col("low").alias("b"))


def tasks_for(rows: int) -> int:
    """Tasks for so many rows of a few numbers each."""
    return max(1, -(-rows // TASK_ROWS))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of `edges` (a, b): the least node that it reaches.

    A round is one job of two exchanges, checkpointed; its count and hash sum, taken on
    the way, tell when nothing changes. Rounds have as many tasks as their edges ask for,
    so few edges don't leave files for every partition of a shuffle. A hub's neighbours are sorted in one task, which
    may spill. Loops and null ends are dropped; repeated edges count once; an empty
    table gives an empty table.
    """
    now, (rows,) = observed(edges.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")), F.count("*"))
    now, seen = now.coalesce(tasks_for(rows)), None
    while True:
        both = now.select(F.inline(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))
        stars = _stars(_stars(both, True, tasks_for(2 * rows)).select(F.col("a").alias("u"), F.col("b").alias("v")), False, tasks_for(2 * rows))
        now, state = observed(stars, F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        if state == seen:
            break
        seen, rows = state, state[0]
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
