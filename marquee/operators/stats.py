"""Counts over the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import text as tx


def movie_counts(reviews: DataFrame, movies: DataFrame) -> DataFrame:
    """Collected reviews per movie, largest first; a movie without any shows 0.

    Meant for the table as collected, before cleaning.
    """
    counted = reviews.groupBy("movie_id").agg(F.count(F.lit(1)).alias("n_reviews"))
    return (
        movies.select("movie_id", "movie_title")
        .join(counted, "movie_id", "left")
        .withColumn("n_reviews", F.coalesce("n_reviews", F.lit(0).cast("bigint")))
        .orderBy(F.col("n_reviews").desc(), "movie_title", "movie_id")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """(value, count, share): shares of the non-null rows, largest first."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )
    total = counted.agg(F.sum("count")).scalar()
    return counted.withColumn("share", F.col("count") / total).orderBy(F.col("count").desc(), "value")


def corpus_stats(df: DataFrame, text: str = "content", approximate: bool = False) -> DataFrame:
    """One row: records, words, distinct words.

    Each record adds one null marker to its tokens, so records and words are
    counted in the same pass; words shrink to one row each before the shuffle.
    """
    marker = F.array(F.lit(None).cast("string"))
    tokens = df.select(F.explode(F.concat(marker, F.coalesce(tx.space_tokens(F.col(text)), F.array().cast("array<string>")))).alias("word"))
    is_word = F.col("word").isNotNull()
    if approximate:
        return tokens.agg(
            F.count_if(~is_word).alias("num_records"),
            F.count_if(is_word).alias("num_words"),
            F.approx_count_distinct("word").alias("num_types"),
        )
    per_word = tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return per_word.agg(
        F.coalesce(F.sum(F.when(~is_word, F.col("n"))), F.lit(0)).alias("num_records"),
        F.coalesce(F.sum(F.when(is_word, F.col("n"))), F.lit(0)).alias("num_words"),
        F.count_if(is_word).alias("num_types"),
    )


def word_counts(df: DataFrame, tokens: Column) -> DataFrame:
    return df.select(F.explode(tokens).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def top_words(df: DataFrame, text: str = "processed_text", k: int = 20) -> DataFrame:
    """The ``k`` most frequent words; ties in word order."""
    return word_counts(df, tx.words(F.col(text))).orderBy(F.col("count").desc(), "word").limit(k)
