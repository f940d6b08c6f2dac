"""Connected components of a graph given by links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaglio.session import durable


def connected_components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node that a link names. links: a, b BIGINT.

    Each round links every node's greater neighbours to its smallest neighbour, then its smaller ones,
    until nothing changes; the number of rounds grows with the logarithm of the longest chain. Minima are
    combined on the map side; the join back on a hub's rows is split by adaptive execution, since its
    other side has one row a node. Links with a null end and from a node to itself are left out.
    """
    edges = durable(links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    nodes = edges
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("node")).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), "m")
        small = large.join(least, F.col("a") == F.col("node")).select(F.greatest("b", "m").alias("x"), F.col("m"), "a")
        edges = durable(
            small.select("a", F.col("m").alias("b")).unionByName(small.select(F.col("x").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        )
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    every = nodes.select(F.col("a").alias("node")).unionByName(nodes.select(F.col("b").alias("node"))).distinct()
    return every.join(edges.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
