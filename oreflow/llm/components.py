"""Connected components of a table of links, without gathering any group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root): each node of the links (a, b) with the smallest node that it reaches.

    Alternates two contractions until nothing changes: every node's larger neighbours move to its
    smallest neighbour, then its smaller ones do. The number of rounds grows with the logarithm of
    the longest path. Sums and minima are partly made before each shuffle; each round is stored.
    """
    edges = materialise(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.min("b").alias("low")), "least")
        low = F.least("a", "low")
        # Larger neighbours of a node to the smallest of node and neighbours.
        large = materialise(
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), low.alias("b")).distinct(), "large-star"
        )
        smaller = materialise(large.groupBy("a").agg(F.min("b").alias("low")), "least")
        moved = materialise(
            large.join(smaller, "a").select(F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e"))
            .select("e.a", "e.b").where("a <> b").distinct(),
            "small-star",
        )
        same = moved.count() == edges.count() and moved.join(edges, ["a", "b"], "left_anti").isEmpty()
        edges = moved
        if same:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
