"""Connected components of links between nodes, as Spark jobs.

Large-star and small-star steps alternate until every node points to the
smallest node of its component.  Each step's links are a stored table; a
node's smallest neighbour is a partial aggregate joined back, so a node with
very many links is no hot task (skewed joins are split at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainyard.llm.common import stored


def _star(neighbours: DataFrame, label: str) -> DataFrame:
    """(u, v) with m, the smallest of u and its neighbours v."""
    least = stored(neighbours.groupBy("u").agg(F.min("v").alias("m")), f"{label}-least")
    return neighbours.join(least, "u").withColumn("m", F.least("u", "m"))


def components(links: DataFrame, label: str = "links") -> DataFrame:
    """node and component (its smallest node) for nodes that are not the
    smallest of their component, from links (a, b); NULLs link nothing."""
    u, v = F.greatest("a", "b"), F.least("a", "b")
    edges = stored(links.filter("a <> b").select(u.alias("u"), v.alias("v")).distinct(),
                   f"{label}-edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, label).filter("v > u").select(F.col("v").alias("u"),
                                                          F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct(), f"{label}-large")
        star = _star(large, label)
        ends = F.explode(F.array("u", "v"))
        small = star.select(ends.alias("u"), F.col("m").alias("v")).filter("u <> v")
        edges = stored(small.distinct(), f"{label}-small")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = state
