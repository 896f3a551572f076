"""Connected components by alternating large-star and small-star steps, wholly as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def _hung(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges with the m of their u.

    least is an aggregate by u, which brings no shuffle of its own into a join by u: AQE could not split a hub. It is
    written first, so that both sides are plain shuffles (or least is broadcast where its files are small).
    """
    return edges.join(least, "u")


def _large_star(edges: DataFrame, made: list[DataFrame]) -> DataFrame:
    """Every neighbour above u is hung onto the smallest node known around u."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    made.append(materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least"))
    return _hung(both.where("v > u"), made[-1]).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()


def _small_star(edges: DataFrame, made: list[DataFrame]) -> DataFrame:
    """u and its smaller neighbours are hung onto the smallest of them; edges come with u above v."""
    made.append(materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "least"))
    moved = _hung(edges, made[-1]).where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(made[-1].select("u", F.col("m").alias("v"))).distinct()


def _only_stars(edges: DataFrame) -> bool:
    """Whether each node either hangs onto one other or has others hung onto it; edges are distinct."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up")))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return not nodes.agg(F.bool_or((F.col("up") > 0) & (F.col("n") > 1)).alias("open")).first().open


def components(edges: DataFrame) -> DataFrame:
    """Columns node, component (smallest node of the component) for every node that has an edge.

    edges: u, v of an orderable type, in any direction, repeats and loops allowed. Rounds grow with the logarithm of the
    longest path and go on until all edges are stars around their smallest nodes; each is written to the shared folder and
    the one before is deleted. Hubs are joined, never gathered.
    """
    now = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "edges")
    while not _only_stars(now):
        last, made = now, []
        large = materialize(_large_star(last, made), "edges")
        now = materialize(_small_star(large, made), "edges")
        for step in (last, large, *made):
            discard(step)
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
