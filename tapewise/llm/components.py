"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapewise.llm.common import checkpointed


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Link every node's neighbours to the least of them and itself (large: the larger neighbours; small: the smaller ones)."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = both if large else both.filter("v < u")
    least = near.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of all linked nodes; ``links`` has two long columns, the component is its least node."""
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges, before = checkpointed(edges), None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        edges = checkpointed(_stars(_stars(edges, True), False))
    found = edges.groupBy("u").agg(F.min("v").alias("component"))
    return found.select(F.col("u").alias("node"), "component").unionByName(
        found.select(F.col("component").alias("node"), "component").distinct())
