"""Connected components of an edge table by alternating large and small stars, without the driver seeing an edge."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _print_of(edges: DataFrame) -> tuple:
    """Count and order-free checksum of an edge table."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of edges(a, b), component being the smallest node reachable.

    Loops, repeated and reversed edges are allowed; rows with a null end are ignored. Each round re-links every node to
    the smallest of its neighbours: the table never grows beyond the distinct edges it began with, and the number of
    rounds is logarithmic in the longest path. Hubs are met by partial minima and by plain joins, which Spark can split.
    """
    e = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    e = cut(e)
    seen = _print_of(e)
    while seen[0]:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        joined = large.join(smallest, "hi")
        small = joined.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo")).unionByName(smallest.select("hi", F.col("m").alias("lo"))).distinct()
        e = cut(small)
        if (now := _print_of(e)) == seen:
            break
        seen = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
