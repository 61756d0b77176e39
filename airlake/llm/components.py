"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airlake.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v); root is the smallest node reachable.

    Large star: every node hands its larger neighbours to its smallest one.
    Small star: the same for its smaller neighbours. Both are an aggregation
    and a join, so a hub's edges are never gathered in one row; each round is
    written to the shared folder. It ends when a round changes nothing, that is
    gives as many edges as before and none that was not there: then
    every component is a star around its root."""
    edges = materialize(
        links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(),
        "edges",
    )
    known = edges.count()
    while known:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(smallest, "u")
        small = small.select("v", "m").where("v > m").union(smallest)
        before, known_before = edges, known
        edges = materialize(small.toDF("u", "v").distinct(), "edges")
        known = edges.count()
        if known == known_before and edges.join(before, ["u", "v"], "left_anti").isEmpty():
            break
    roots = edges.select("v").distinct()
    return edges.toDF("node", "root").union(roots.select(F.col("v").alias("node"), F.col("v").alias("root")))
