"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evenkeel.llm.common import cut, drop_tables


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def _star(pairs: DataFrame) -> DataFrame:
    """Of each ``u`` and its ``v``: all linked to the smallest. The smallest is found by
    an aggregation that combines before it shuffles; a hot ``u`` is a skewed join."""
    least = pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    linked = pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return linked.unionByName(least.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, label) for every node that has a link; the label is the component's
    smallest node. Links to itself and repeated links do no harm. Edges are written
    to the shared folder after each step; nothing but a checksum reaches the driver.
    """
    edges = cut(links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where(
        F.col("u") != F.col("v")).distinct(), "edges")
    before = None
    while (now := _state(edges)) != before:
        before, old = now, edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where(F.col("u") > F.col("v"))
        small = _star(large).where(F.col("u") > F.col("v")).distinct()
        edges = cut(small, "edges")
        drop_tables(edges.sparkSession, [old])
    roots = edges.select(F.col("v").alias("u")).distinct().withColumn("v", F.col("u"))
    return edges.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("label"))
