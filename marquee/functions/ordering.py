"""Repeatable pseudo-random order."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw_key(seed: int, key: Column) -> Column:
    """``md5(seed:key)``: the same order on any cluster, engine and partitioning."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
