"""Connected components of a link table, as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.session import materialize


def components(links: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): the least node of each connected component, for
    every node that occurs in a link (Kiveris et al. 2014, alternating large
    and small stars: O(log^2 n) rounds whatever the shape).  Each round's
    links, at most as many as there were, are written to the shared folder,
    so a lost executor costs one round.  Nodes may be of any ordered type;
    rows with a null node are ignored.  The rounds move single nodes and
    minima, never a group."""
    edges = materialize(
        links.select(F.least(u, v).alias("low"), F.greatest(u, v).alias("high"))
        .where("low is not null and high is not null").distinct(), "links")
    before = None
    while True:
        # Large star: each node's larger neighbours are linked to the least of its neighbourhood.
        both = edges.select(F.col("low").alias("a"), F.col("high").alias("b")).unionByName(
            edges.where("low <> high").select(F.col("high").alias("a"), F.col("low").alias("b")))
        # The minima are written, so that the join below shuffles both sides and AQE can
        # split the rows of a node with very many neighbours.
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("m").alias("low"), F.col("b").alias("high")).distinct()
        # Small star: each node's smaller neighbours, and itself, are linked to the least of them.
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(least, "high")
        edges = materialize(
            small.select(F.col("m").alias("low"), F.col("low").alias("high"))
            .unionByName(least.select(F.col("m").alias("low"), "high"))
            .where("low <> high").distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = edges.select(F.col("low").alias("node")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component")))
