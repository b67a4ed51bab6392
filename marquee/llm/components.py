"""Connected components of a table of edges.

Alternates large-star and small-star steps: every round hangs nodes below
smaller neighbours until each component is a star around its smallest node.
Both steps are a partial minimum and an equi-join, so neither a hub nor a long
chain is one task's work; the number of rounds grows with the logarithm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.session import materialise, release


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """Edges (high, low) after one step."""
    both = edges if small else edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.least(F.min("low"), F.first("high")).alias("least"))
    joined = both.join(least, "high")
    if small:  # the smaller neighbours and the node itself move to the smallest of them
        moved = joined.select(F.col("low").alias("high"), F.col("least").alias("low"))
        moved = moved.unionByName(least.select("high", F.col("least").alias("low")))
    else:  # the larger neighbours move to the smallest neighbour
        moved = joined.where("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        moved = moved.unionByName(least.where("least < high").select("high", F.col("least").alias("low")))
    return moved.where("high > low").distinct()


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for every node of an edge between two different nodes; the root is the smallest node."""
    a, b = F.col(left), F.col(right)
    now = edges.where(a != b).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()
    now = materialise(now, "components")
    mark = None
    while True:
        found = now.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if tuple(found) == mark:
            break
        mark = tuple(found)
        if not found[0]:
            break
        large = materialise(_star(now, small=False), "components-large")
        before, now = now, materialise(_star(large, small=True), "components-small")
        release(before, large)
    return now.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        now.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )
