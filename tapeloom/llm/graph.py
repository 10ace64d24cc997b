"""Connected components of a set of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir


def components(links: DataFrame, a: str = "a", b: str = "b", most: int = 60) -> DataFrame:
    """(node, component) for every node of a link; component is the smallest node reachable.

    Each round points every node's larger neighbours at its smallest one, then every node and its smaller neighbours
    likewise, until nothing changes; rounds grow with the logarithm of a component's diameter.  Every aggregate
    is combined before its shuffle, and the join back to a node with many links is one that Spark can split.
    Lineage is cut in the shared checkpoint folder each round.  Links of a node to itself and repeated links do no harm.
    """
    shared_dir(links.sparkSession)
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct().checkpoint()
    before = None
    for _ in range(most):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = small.where("u <> v").distinct().checkpoint()
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components haven't settled")
    return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
