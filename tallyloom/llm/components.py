"""Connected components of an edge list, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import staged


def connected_components(edges: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """``node, component`` for every node of an edge list; the component is its smallest node.

    Nodes may be of any type with an order. Null ends and loops are ignored as links; a node that has only loops is
    a component of its own. Works by stars: each node points at the smallest node it knows of, first its larger
    neighbours, then its smaller ones, until nothing changes. Each round reads a staged table and only
    pre-aggregated minima are shuffled, so a node with very many neighbours is no hot group; the number of rounds is
    about the logarithm of the longest path.
    """
    links = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).filter("u is not null and v is not null")
    alone = links.select(F.col("u").alias("node")).distinct()
    current = staged(
        links.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    while True:
        # Large star: every larger neighbour of u points at the smallest of u and its neighbours.
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter("u <> v").distinct()
        )
        # Small star: u and its smaller neighbours point at the smallest of them.
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smallest, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct()
        )
        following = staged(small)
        # Finished when every node has one parent and no parent has a parent.
        state = following.groupBy("u").agg(F.count("*").alias("n"))
        open_nodes = state.filter("n > 1").limit(1).count()
        open_paths = 0 if open_nodes else following.join(following.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count()
        current = following
        if not open_nodes and not open_paths:
            break
    nodes = alone.unionByName(links.select(F.col("v").alias("node"))).distinct()
    return nodes.join(current.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )
