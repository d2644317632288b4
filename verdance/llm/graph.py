"""Connected components of an edge table, by repeated large-star and small-star steps.

Every step is an aggregation and a join; no neighbourhood is gathered, so a node with a third
of all edges costs one pre-aggregated row per task and a join that the planner may split. The
edges of each step are stored, so a lost executor repeats a part of one step only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdance.llm.common import forget, stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges hold (u, v) with u > v. Large: each larger neighbour is tied to the smallest of the
    neighbourhood. Small: each smaller neighbour and the node itself are."""
    if large:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        low = stored(low, "star")
        out = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        low = stored(edges.groupBy("u").agg(F.min("v").alias("low")), "star")
        out = edges.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).union(low.toDF("u", "v"))
    done = stored(out.where("u > v").distinct(), "edges")
    forget(low)
    return done


def _all_stars(edges: DataFrame) -> bool:
    """Whether every node is tied to one smaller node at most, and that one to none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(
        edges.select("v", F.lit(0), F.lit(1))
    )
    per = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return per.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0))).isEmpty()


def components(pairs: DataFrame) -> DataFrame:
    """(node, comp) for every node of ``pairs`` (two columns of longs): comp is the smallest
    node that can be reached. Stored. Loops, repeated and reversed pairs do no harm."""
    a, b = pairs.columns[:2]
    edges = stored(
        pairs.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    loops = pairs.where(F.col(a) == F.col(b)).select(F.col(a).alias("node"))
    while not _all_stars(edges):
        wide = _star(edges, True)
        narrow = _star(wide, False)
        forget(edges, wide)
        edges = narrow
    roots = edges.select(F.col("v").alias("node")).union(loops).distinct().join(edges.select(F.col("u").alias("node")), "node", "left_anti")
    done = stored(edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(roots.select("node", F.col("node").alias("comp"))), "components")
    forget(edges)
    return done
