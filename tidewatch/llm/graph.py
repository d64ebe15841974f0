"""Connected components of an edge table by alternating large-star and small-star joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.scan import split_join
from tidewatch.session import checkpoint_root


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and continue from there."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node of the distinct edges (u, v) with v < u is a centre (v) or has one centre and is none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up")).union(edges.select("v", F.lit(0)))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return not nodes.agg(F.max((F.col("ups") > 1) | ((F.col("ups") > 0) & (F.col("least") == 0)))).first()[0]


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v); component is the smallest node reachable.

    Self-loops, repeated edges and null ends are dropped; a node without any
    other end does not appear. Rounds go on until the edges are stars, each node
    with its smallest one (O(log^2 n) rounds, none if they are so from the start); each one is a partial-aggregate minimum and an equi-join on the
    node, which adaptive execution can split where a node is hot.
    """
    e = cut(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    while not _are_stars(e):
        both = e.union(e.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = split_join(both, low, ["u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (split_join(large, low, ["u"]).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))))
        e = cut(small.where("u <> v").distinct())
    own = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own)
