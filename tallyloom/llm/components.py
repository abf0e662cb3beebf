"""Connected components of a table of edges.

Defined results: edges may be repeated and stand either way round; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.sources.stage import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )


def _stars(pairs: DataFrame, keep) -> DataFrame:
    """Link the neighbours of each node to its smallest neighbour, itself included."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = pairs.join(least, "u").where(keep).select(F.col("v").alias("a"), F.col("m").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return linked.unionByName(own).where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of (a, b); the component is its smallest node.

    Large-star and small-star steps take turns until nothing changes. Each is a combine
    and a join over the edges, never more rows than there were edges and nodes.
    """
    current = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        large = _stars(_both_ways(current), F.col("v") > F.col("u"))
        # small star: only neighbours below a node
        current = stage(_stars(large.select(F.col("a").alias("u"), F.col("b").alias("v")), F.lit(True)))
        mark = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if mark == before:
            break
        before = mark
    roots = current.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
