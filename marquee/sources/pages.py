"""Saved response pages: one JSON text per page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.schema import PAGE_SCHEMA, REVIEW_COLUMNS


def _parsed(pages: DataFrame, body: str) -> DataFrame:
    return pages.withColumn("page", F.from_json(F.col(body), PAGE_SCHEMA))


def flatten_review_pages(
    pages: DataFrame, movies: DataFrame, body: str = "body", movie_id: str = "movie_id"
) -> DataFrame:
    """One row per ``edges[].node``; pages that carry ``errors`` give none.

    Any level of a node may be null: field access on a null struct is null, so
    an edge with a null node still makes a row.  The title comes from
    ``movies``; an unknown movie keeps its reviews, with a null title.
    """
    nodes = (
        _parsed(pages, body)
        .filter(F.col("page").isNotNull() & F.col("page.errors").isNull())
        .select(F.col(movie_id).alias("movie_id"), F.explode("page.data.title.reviews.edges.node").alias("node"))
    )
    rows = nodes.select(
        "movie_id",
        F.col("node.id").alias("review_id"),
        F.col("node.author.nickName").alias("author"),
        F.col("node.authorRating").alias("author_rating"),
        F.col("node.helpfulness.upVotes").alias("upvotes"),
        F.col("node.helpfulness.downVotes").alias("downvotes"),
        F.col("node.submissionDate").alias("submission_date"),
        F.col("node.summary.originalText").alias("summary"),
        F.col("node.text.originalText.plainText").alias("content"),
    )
    return rows.join(movies.select("movie_id", "movie_title"), "movie_id", "left").select(*REVIEW_COLUMNS)


def page_status(pages: DataFrame, body: str = "body", keep: tuple[str, ...] = ("movie_id", "page_no")) -> DataFrame:
    """Where a movie's page chain goes on: next cursor, or ``is_last``.

    A page is the last when it says so, or when it names no cursor to go on
    with.  Error pages are dropped.
    """
    info = F.col("page.data.title.reviews.pageInfo")
    more = F.coalesce(info["hasNextPage"], F.lit(False))
    cursor = info["endCursor"]
    goes_on = more & cursor.isNotNull() & (cursor != "")
    return (
        _parsed(pages, body)
        .filter(F.col("page").isNotNull() & F.col("page.errors").isNull())
        .select(
            *keep,
            F.coalesce(F.size("page.data.title.reviews.edges"), F.lit(0)).alias("n_reviews"),
            more.alias("has_next_page"),
            cursor.alias("end_cursor"),
            (~goes_on).alias("is_last"),
        )
    )
