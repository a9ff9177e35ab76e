"""Connected components by alternating large and small stars.

Each step replaces edges by edges to smaller neighbours and is two shuffles with
map-side combine; a hub with a third of all edges is one key of a join that
adaptive execution can split. Steps end when all that is left is stars.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import keep


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (
        both.where("v > u").join(least, "u")
        .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one edge to a smaller node, or only edges from larger ones."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    )
    each = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return each.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """``node, component`` of every node with an edge; the component is its smallest node.

    Nulls and self-loops are no edges. No edges give no rows.
    """
    now = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).where(
        F.col(u).isNotNull() & F.col(v).isNotNull() & (F.col(u) != F.col(v))
    )
    now = keep(now.distinct(), "edges")
    while not _is_stars(now):
        now = keep(_small_star(_large_star(now)), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
