"""Connected components of links, by star contraction; every step is a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.common import saved

HOT, MOST_HOT = 1000, 100_000


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``links`` (u, v) reaches.

    Large-star and small-star steps take turns until the edges form stars.  Nodes
    without links, and links with a null end, do not appear.  Repeated links, links
    in both directions and links of a node with itself do no harm.
    """
    edges = saved(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .filter("u IS NOT NULL AND v IS NOT NULL AND u > v").distinct(),
        "edges",
    )
    while not are_stars(edges):
        edges = saved(small_star(large_star(edges, edges.count())), "edges")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots)


def are_stars(edges: DataFrame) -> bool:
    """Whether every node is a centre, or linked to one centre alone."""
    up, down = F.lit(1).alias("up"), F.lit(0).alias("up")
    ends = edges.select(F.col("u").alias("node"), up).unionByName(edges.select(F.col("v").alias("node"), down))
    kinds = ends.groupBy("node").agg(F.sum("up").alias("n"), F.min("up").alias("least"))
    return kinds.filter("n > 1 OR n = 1 AND least = 0").isEmpty()


def large_star(edges: DataFrame, size: int) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of its neighbourhood.

    Nodes with more neighbours than ``HOT`` and than the ``MOST_HOT``-th part of the ``size`` edges, of which there
    are at most twice ``MOST_HOT``, are broadcast, so that their neighbours stay where they are.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    smallest = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
    hot = F.col("n") > max(HOT, size // MOST_HOT)
    larger = both.filter("v > u").join(F.broadcast(smallest.filter(hot).select("u", F.col("m").alias("known"))), "u", "left")
    met = larger.filter("known IS NULL").join(smallest.filter(~hot).select("u", "m"), "u")
    return larger.filter("known IS NOT NULL").select(F.col("v").alias("u"), F.col("known").alias("v")).unionByName(
        met.select(F.col("v").alias("u"), F.col("m").alias("v")))


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(smallest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()
