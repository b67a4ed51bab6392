"""Samples and splits, repeatable through ``draw_key``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions.ordering import draw_key
from marquee.operators.groups import smallest_in_group, stored_keys, top_per_group
from marquee.operators.rows import without
from marquee.session import materialise

LABEL_COLUMNS = [
    "review_id", "movie_id", "movie_title", "author_rating", "submission_date", "summary", "content",
]


def label_sample(
    df: DataFrame,
    total: int = 1000,
    ratings: Sequence[int] = tuple(range(1, 11)),
    seed: int = 42,
) -> DataFrame:
    """Rows to label: equal per rating, inside a rating equal per movie.

    1. a rating's target is ``total / ratings``, at most what it has; movies
       share it evenly, the remainder going to the first titles;
    2. what small movies leave open is drawn from the rest of the rating;
    3. what small ratings leave open is drawn from all other rows.

    Steps 1 and 2 never take more than a rating's target, so no trimming is
    left to do.  Expects the result of ``valid_ratings``.
    """
    per_rating = total // len(ratings)
    # Read by every step below, so its (narrow) rows are written once.
    narrow = materialise(
        df.filter(F.col("author_rating").isin(list(ratings))).select(
            "review_id", "movie_title", "author_rating", draw_key(seed, F.col("review_id")).alias("_draw")
        ),
        "label-candidates",
    )
    order = [F.col("_draw"), F.col("review_id")]

    cells = narrow.groupBy("author_rating", "movie_title").agg(F.count(F.lit(1)).alias("_n"))
    targets = (
        cells.groupBy("author_rating")
        .agg(F.sum("_n").alias("_n_rating"), F.count(F.lit(1)).alias("_movies"))
        .select(
            "author_rating",
            "_movies",
            F.least(F.lit(per_rating).cast("bigint"), "_n_rating").alias("_target"),
        )
    )
    # A movie past the first `per_rating` titles can have no share: with more
    # movies than that, each of the first ones gets a single row.
    quotas = (
        top_per_group(cells, ["author_rating"], [F.col("movie_title")], per_rating, "_title_no")
        .join(targets, "author_rating")
        .withColumn(
            "_quota",
            F.floor(F.col("_target") / F.col("_movies"))
            + F.when(F.col("_title_no") <= F.col("_target") % F.col("_movies"), 1).otherwise(0),
        )
        .withColumn("_take", F.least("_quota", "_n"))
    )
    open_places = quotas.groupBy("author_rating").agg(
        (F.first("_target") - F.sum("_take")).alias("_open")
    )

    # No cell can give more rows than its rating's target.
    drawn = top_per_group(narrow, ["author_rating", "movie_title"], order, per_rating, "_rn").join(
        quotas.select("author_rating", "movie_title", "_quota"), ["author_rating", "movie_title"]
    )
    first_pass = drawn.filter(F.col("_rn") <= F.col("_quota")).select("review_id")
    second_pass = (
        top_per_group(
            drawn.filter(F.col("_rn") > F.col("_quota")), ["author_rating"], order, per_rating, "_rn2"
        )
        .join(open_places, "author_rating")
        .filter(F.col("_rn2") <= F.col("_open"))
        .select("review_id")
    )
    inside = first_pass.unionByName(second_pass)

    missing = inside.agg((F.lit(total) - F.count(F.lit(1))).alias("_missing")).scalar()
    others = (
        narrow.join(stored_keys(inside), "review_id", "left_anti")
        .orderBy(*order)
        .limit(total)
        .withColumn("_rn", F.row_number().over(Window.orderBy(*order)))
        .filter(F.col("_rn") <= missing)
        .select("review_id")
    )
    chosen = inside.unionByName(others)
    blanks = [F.lit("").alias(c) for c in ("subjective_label", "polarity_label", "notes")]
    return df.join(stored_keys(chosen), "review_id", "left_semi").select(*LABEL_COLUMNS, *blanks)


def equal_rating_sample(
    df: DataFrame,
    seen: DataFrame,
    total: int = 300,
    low: int = 1,
    high: int = 10,
    seed: int = 99,
) -> DataFrame:
    """The same number of rows of every rounded rating, none of them in ``seen``.

    Raises when the total cannot be divided evenly, or when the candidates or
    one rating fall short.  Rows come out in a shuffled, repeatable order.
    """
    groups = high - low + 1
    if total % groups:
        raise ValueError(f"a total of {total} cannot be split evenly over {groups} ratings")
    each = total // groups
    rating = F.bround(F.expr("try_cast(author_rating as double)"), 0).cast("int")
    candidates = (
        df.withColumn("_rating", rating)
        .filter(F.col("_rating").isNotNull())
    )
    candidates = without(candidates, seen)
    counts = {r["_rating"]: r["n"] for r in _rating_counts(candidates, low, high)}
    available = sum(counts.values())
    if available < total:
        raise ValueError(f"only {available} unseen reviews for a sample of {total}")
    for value in range(low, high + 1):
        have = counts.get(value, 0)
        if have < each:
            raise ValueError(f"rating {value} has {have} unseen reviews, the sample needs {each}")
    draw = [draw_key(seed, F.col("review_id")), F.col("review_id")]
    picked = top_per_group(candidates.filter(F.col("_rating").between(low, high)), ["_rating"], draw, each, "_rn")
    return picked.orderBy(draw_key(seed + 1, F.col("review_id")), "review_id").select(
        "review_id", "movie_id", "movie_title", "author_rating", "summary", "content", F.lit("").alias("ground_truth")
    )


def _rating_counts(candidates: DataFrame, low: int, high: int) -> list:
    """Rows per rating inside the range, and one row for all others together."""
    bucket = F.when(F.col("_rating").between(low, high), F.col("_rating"))
    return candidates.groupBy(bucket.alias("_rating")).agg(F.count(F.lit(1)).alias("n")).collect()


def strata_key(*columns: str) -> Column:
    return F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("nan")) for c in columns])


def stratified_split(
    df: DataFrame,
    strata: Sequence[str],
    fraction: float = 0.2,
    seed: int = 42,
    doc_id: str = "review_id",
) -> DataFrame:
    """Add ``split``: ``test`` for the given share of each stratum, else ``train``.

    A stratum of ``n`` rows gives ``floor(n * fraction + 0.5)`` test rows; a
    stratum of one row goes to train.
    """
    keyed = df.withColumns({"_stratum": strata_key(*strata), "_draw": draw_key(seed, F.col(doc_id))})
    quota = F.when(F.col("n") > 1, F.floor(F.col("n") * F.lit(fraction) + F.lit(0.5))).otherwise(0)
    marked = smallest_in_group(keyed, ["_stratum"], quota, "_draw", doc_id, "_is_test")
    return marked.withColumn("split", F.when(F.col("_is_test"), "test").otherwise("train")).drop(
        "_is_test", "_stratum", "_draw"
    )
