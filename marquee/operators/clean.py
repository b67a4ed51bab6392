"""Review rows: cleaning, rating checks, index documents."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import text as tx
from marquee.operators.groups import first_per_key
from marquee.session import materialise


def _first_review(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    rest = [c for c in df.columns if c != "review_id" and c not in order_by]
    return first_per_key(df, ["review_id"], [F.col(c).asc_nulls_last() for c in (*order_by, *rest)])


def _one_line(text: str) -> Column:
    return F.trim(F.translate(F.coalesce(F.col(text), F.lit("")), "\n\r", "  "))


def clean_reviews(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Texts on one line, one row per review id, no empty content.

    Of several rows with one id the first by ``order_by`` stays (then by the
    remaining columns, so that the choice never depends on the partitioning).
    The empty check comes after the choice: an id whose first row is empty goes.
    """
    lined = df.withColumns({"content": _one_line("content"), "summary": _one_line("summary")})
    return _first_review(lined, order_by).filter(F.length("content") > 0)


def valid_ratings(df: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """Complete rows with a whole rating from 1 to 10, one per review id.

    A null in any column drops the row.
    """
    # One condition per column: a single one over all columns makes the
    # optimizer try every combination of column aliases.
    complete = df.filter(reduce(and_, [F.col(c).isNotNull() for c in df.columns]))
    kept = _first_review(complete, order_by).filter(F.col("content").rlike(tx.WORD_RUN))
    rating = F.expr("try_cast(author_rating as double)")
    return kept.filter(rating.isin([float(r) for r in range(1, 11)])).withColumn("author_rating", rating.cast("int"))


def with_row_ids(df: DataFrame, order_by: Sequence[str], name: str = "review_id") -> DataFrame:
    """Give rows a 0-based id by ``order_by`` when they have none.

    The sorted rows are written once with their partition and place in it, so
    that both passes below read the same stored places.  Only one count per
    partition is brought together.
    """
    if name in df.columns:
        return df
    ordered = materialise(
        df.orderBy(*order_by).withColumns(
            {"_part": F.spark_partition_id(), "_step": F.monotonically_increasing_id()}
        ),
        "row-ids",
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"), F.min("_step").alias("_start"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    )
    # One row per partition of the sort: bounded by the partition count.
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_step") - F.col("_start"))
        .select(name, *df.columns)
    )


def to_index_docs(df: DataFrame) -> DataFrame:
    """The stored form of a review: nulls filled, helpfulness and year added."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    up = F.coalesce(F.col("upvotes").cast("int"), F.lit(0))
    down = F.coalesce(F.col("downvotes").cast("int"), F.lit(0))
    date = text("submission_date")
    return df.select(
        text("review_id").alias("id"),
        text("movie_id").alias("movie_id"),
        text("movie_title").alias("movie_title"),
        text("author").alias("author"),
        F.coalesce(F.col("author_rating").cast("double"), F.lit(0.0)).alias("author_rating"),
        up.alias("upvotes"),
        down.alias("downvotes"),
        (up / (up + down + 1)).alias("helpfulness_score"),
        F.try_to_timestamp(date, F.lit("yyyy-MM-dd")).alias("submission_date"),
        F.when(F.length(date) >= 4, F.substring(date, 1, 4).try_cast("int"))
        .otherwise(F.lit(0))
        .alias("year"),
        text("summary").alias("summary"),
        text("content").alias("content"),
        F.lit("").alias("sentiment"),
    )
