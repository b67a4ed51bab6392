"""Joins that keep a promise about the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.operators.groups import stored_keys


def attach_text(rows: DataFrame, texts: DataFrame, text: str, doc_id: str = "review_id") -> DataFrame:
    """Left join of ``texts``; the job fails when a row finds no text.

    The check runs inside the plan, so it costs no pass of its own.
    """
    joined = rows.join(texts.select(doc_id, text), doc_id, "left")
    message = F.concat(F.lit(f"no {text} for {doc_id} "), F.coalesce(F.col(doc_id).cast("string"), F.lit("null")))
    found = F.when(F.col(text).isNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return joined.filter(found)


def without(df: DataFrame, seen: DataFrame, keys: Sequence[str] = ("review_id",)) -> DataFrame:
    """Rows whose key does not occur in ``seen``."""
    known = seen.select(*keys).filter(F.col(keys[0]).isNotNull()).distinct()
    return df.join(stored_keys(known), list(keys), "left_anti")


def overlap_count(df: DataFrame, other: DataFrame, key: str = "review_id") -> DataFrame:
    """One row: how many rows of ``df`` have a key that occurs in ``other``."""
    known = stored_keys(other.select(key).distinct())
    return df.join(known, key, "left_semi").agg(F.count(F.lit(1)).alias("n_common"))


def attach_sentiment(docs: DataFrame, predictions: DataFrame, model: str) -> DataFrame:
    """Fill ``sentiment`` of index documents from one model's labels.

    Several labels of one id are brought to the greatest by a partial
    aggregate, so the join adds no rows.
    """
    labels = (
        predictions.filter(F.col("model") == model)
        .groupBy(F.col("review_id").alias("id"))
        .agg(F.max("predicted_label").alias("_label"))
    )
    filled = docs.join(labels, "id", "left").withColumn("sentiment", F.coalesce("_label", "sentiment"))
    return filled.select(*docs.columns)
