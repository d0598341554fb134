"""Connected components of an edge table, as repeated joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm._shared import stored


def components(edges: DataFrame, folder: str, name: str) -> DataFrame:
    """``edges(a, b)`` (bigint, undirected) -> ``(node, comp)`` for every node
    that has an edge; ``comp`` is the smallest node of its component.

    Alternates two steps until the edges are stars (both keep connectivity):
    *large star* links the larger neighbours of a node to the smallest node of
    its neighbourhood, *small star* the smaller ones and the node itself.  The
    result is one star per component around its smallest node; the number of
    rounds grows with the logarithm of the component size, and edges that are
    stars already need none.  Minima are partial
    aggregates and the joins carry two integers a row, so a node with very many
    edges is split like any skewed join key.
    """
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")) \
        .where("a is not null and b is not null and a <> b")
    now = stored(_down(pairs).distinct(), folder, f"{name}-0")
    step = 0
    while not _are_stars(now):
        step += 1
        now = stored(_small_star(_large_star(now)), folder, f"{name}-{step}")
    tails = now.select(F.col("u").alias("node"), F.col("v").alias("comp"))
    heads = now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct()
    return tails.unionByName(heads)


def _down(pairs: DataFrame) -> DataFrame:
    """Each edge from its larger end u to its smaller end v."""
    return pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node is the larger end of no edge, or of one and the smaller
    end of none: then every edge leads to the smallest node of its component."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
        .unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.where("up > 1 or up = 1 and down = 1").agg(F.count("*")).first()[0] == 0


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")) \
        .select("u", F.least("u", "m").alias("m"))
    # for every neighbour v of u with v > u: link v to the least of u's neighbourhood
    return (edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    # of distinct edges each u has one to its least neighbour: that row stays (u, m), the others become (v, m)
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return edges.join(least, "u") \
        .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).distinct()
