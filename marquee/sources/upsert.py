"""Adding batches to a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.groups import stored_keys, first_per_key


def upsert_reviews(
    current: DataFrame,
    *batches: DataFrame,
    key: str = "id",
    tie_break: tuple[str, ...] = (),
) -> DataFrame:
    """``current`` with ``batches`` laid over it; the newest row of a key wins.

    ``current`` is a keyed table: one row per key, as an earlier upsert leaves
    it.  Inside one batch the first row by ``tie_break`` and then by the
    remaining columns wins, so the result does not depend on the partitioning.
    Only the batches are sorted; the current rows are checked against the new
    keys, without a shuffle when those are few.
    """
    stacked = None
    for number, layer in enumerate(batches):
        numbered = layer.select(*current.columns).withColumn("_batch", F.lit(number))
        stacked = numbered if stacked is None else stacked.unionByName(numbered)
    if stacked is None:
        return current
    rest = [c for c in current.columns if c != key and c not in tie_break]
    order = [F.col("_batch").desc(), *[F.col(c).asc_nulls_last() for c in (*tie_break, *rest)]]
    newest = first_per_key(stacked, [key], order).drop("_batch")
    replaced = stored_keys(stacked.select(F.col(key).alias("_new")).distinct())
    kept = current.join(replaced, F.col(key).eqNullSafe(F.col("_new")), "left_anti")
    return kept.unionByName(newest)
