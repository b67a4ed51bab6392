"""Counts of field values over the documents a request finds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.groups import top_per_group


def _filled(df: DataFrame, value: str = "value") -> DataFrame:
    return df.filter(F.col(value).isNotNull() & (F.col(value) != ""))


def facet_field(
    hits: DataFrame, field: str, limit: int = 20, mincount: int = 1, corpus: DataFrame | None = None
) -> DataFrame:
    """(value, count), largest first, ties by value; blank values are no bucket.

    With ``mincount=0`` the values of ``corpus`` that no hit has are listed too.
    """
    counted = _filled(hits.select(F.col(field).cast("string").alias("value"))).groupBy("value").agg(
        F.count(F.lit(1)).alias("count")
    )
    if mincount == 0:
        if corpus is None:
            raise ValueError("mincount=0 needs the corpus the values come from")
        known = _filled(corpus.select(F.col(field).cast("string").alias("value"))).distinct()
        counted = known.join(counted, "value", "left").withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))
    return counted.filter(F.col("count") >= mincount).orderBy(F.col("count").desc(), "value").limit(limit)


def facet_many(hits: DataFrame, fields: Sequence[str], limit: int = 10, mincount: int = 1) -> DataFrame:
    """(field, value, count): several facets in one pass over the hits."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    counted = (
        _filled(hits.select(F.inline(pairs)))
        .groupBy("field", "value")
        .agg(F.count(F.lit(1)).alias("count"))
        .filter(F.col("count") >= mincount)
    )
    return top_per_group(counted, ["field"], [F.col("count").desc(), F.col("value")], limit).drop("rn")


def facet_range(
    hits: DataFrame, field: str, start: float = 1, end: float = 10, gap: float = 3, include_upper: bool = False
) -> DataFrame:
    """(bucket_start, bucket_end, count) for every bucket, empty ones too.

    Buckets are closed below and open above and stop at ``end``, so a value
    equal to ``end`` is in none unless ``include_upper`` is set.
    """
    buckets = max(0, -int(-(end - start) // gap))
    value = F.col(field)
    number = F.floor((value - start) / gap)
    inside = (value >= start) & (value < end)
    if include_upper:
        number = F.least(number, F.lit(buckets - 1))
        inside = (value >= start) & (value <= end)
    counted = hits.filter(inside).groupBy(number.cast("bigint").alias("bucket")).agg(F.count(F.lit(1)).alias("count"))
    low = F.lit(float(start)) + F.col("bucket") * float(gap)
    # As many rows as the caller asked for buckets.
    return (
        hits.sparkSession.range(buckets)
        .withColumnRenamed("id", "bucket")
        .join(counted, "bucket", "left")
        .select(
            low.alias("bucket_start"),
            F.least(low + float(gap), F.lit(float(end))).alias("bucket_end"),
            F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
        )
    )
