"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from locusflow.session import materialize


def _least(pairs: DataFrame) -> DataFrame:
    """The least neighbour of each node; pre-aggregated, so a hub costs one row per task."""
    return pairs.groupBy("a").agg(F.min("b").alias("m"))


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """True when every node hangs on one node that itself hangs on none; pre-aggregated per node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
    ends = ends.unionByName(edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    per = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return per.filter("hangs > 1 OR (hangs = 1 AND holds = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b`` of one type); the component is its least node.

    A large-star step joins each node's larger neighbours to its least one, a small-star step its smaller ones; both
    are an aggregate and an equi-join.  They alternate until every node hangs on the least node of its component.
    Each round ends in a written table.  Loops and repeated edges do no harm; without edges there is no row.
    """
    now = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while not _is_forest_of_stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.join(_least(large), "a")
        hung = small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialize(hung.unionByName(small.select("a", F.col("m").alias("b"))).distinct())
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
