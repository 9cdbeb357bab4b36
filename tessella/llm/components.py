"""Connected components by alternating star contractions, wholly in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored

ROUNDS = 50


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    ``edges`` hold two comparable columns; direction, repeats and self loops do not matter and null ends
    are left out.  Every round is a large-star and a small-star step written to the shared folder; a hub's
    neighbours are reduced by ``min`` with map-side combining, never gathered.  Rounds grow with the
    logarithm of the longest path.  No edges give an empty table.
    """
    links = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u is not null and v is not null and u <> v").distinct(),
        "links",
    )
    for _ in range(ROUNDS):
        # Large star: each node's larger neighbours move to the smallest of its neighbourhood.
        both = links.union(links.select("v", "u")).toDF("x", "y")
        low = both.groupBy("x").agg(F.least(F.col("x"), F.min("y")).alias("m"))
        large = both.where("y > x").join(low, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: each node and its smaller neighbours move to the smallest of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        after = stored(small, "links")
        # Settled when every node has one link, to a node that has none of its own.
        own = after.groupBy("u").agg(F.count("*").alias("n"))
        open_ = own.where("n > 1").select("u").union(after.select(F.col("v").alias("u")).join(own.select("u"), "u", "left_semi").select("u"))
        settled = open_.isEmpty()
        discard(links)
        links = after
        if settled:
            break
    else:
        raise RuntimeError("components did not settle")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(links.select("v", "v")).distinct()
