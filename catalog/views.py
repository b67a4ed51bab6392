"""The inputs of the registered queries, as Spark views of the given tables.

``sql_views.py`` holds the same formulas for DuckDB.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.text import combine_text
from marquee.operators.clean import to_index_docs
from marquee.operators.tokens import merge_dictionaries

PAGE_SPAN = 250  # doc ids per saved page and movie

# Small dictionaries of our own, made of words that are frequent in `documents`.
GENERAL_SLANG = [
    ("that", "that one"), ("with", "along with"), ("tion", "transition"), ("thon", "marathon"),
    ("elle", "she"), ("nicht", "not"), ("dans", "inside of"), ("pour", "for"), ("sich", "oneself"),
    ("thor", "general thor"), ("es", "it"), ("&", "and"),
]
DOMAIN_SLANG = [("thor", "thunder god"), ("pathetic", "very bad"), ("worthless", "very bad"), ("thing", "matter")]
LEMMAS = [
    ("ered", "er"), ("ering", "er"), ("mente", "ment"), ("heit", "Heit"), ("ones", "one"), ("ertion", "ert"),
    ("threinble", "three"), ("edtioner", "edit"), ("bad", "Bad"), ("inea", "inch"), ("onin", "on"),
]
STOP_WORDS = [
    "the", "and", "of", "to", "in", "is", "it", "on", "as", "la", "le", "de", "des", "et", "que", "un", "une",
    "en", "el", "los", "der", "die", "das", "und", "one", "very", "for", "not",
]
ALIASES = [("tiny plate", "red plate"), ("anvil of size", "large anvil")]
TIMES = [
    ("preprocessed_text", "model_a", 0.5), ("preprocessed_text", "model_b", 0.0),
    ("augmented_text", "model_a", 0.25), ("augmented_text", "model_b", 2.0),
]
# Every n-th document a model gets wrong.
WRONG = [
    ("preprocessed_text", "model_a", 7), ("preprocessed_text", "model_b", 5),
    ("augmented_text", "model_a", 6), ("augmented_text", "model_b", 9),
]


WAVE_BYTES = 128 << 20  # what one task reads in one go


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a table that is too small to fill one wave.

    A small file is one row group, hence one task, however many cores wait.  A
    table of more than one wave of splits is left as it is read: at scale no
    shuffle is added.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores, key) if size < cores * WAVE_BYTES else df


def documents(spark: SparkSession, d: str) -> DataFrame:
    return spread(table(spark, d, "documents"), "doc_id")


def reviews(spark: SparkSession, d: str) -> DataFrame:
    """The review columns plus ``doc_id``, which other views count with."""
    joined = (
        documents(spark, d)
        .select("doc_id", "text")
        .join(table(spark, d, "orders"), F.col("doc_id") == F.col("o_orderkey"))
        .join(
            table(spark, d, "part").filter("p_partkey < 40").select("p_partkey", "p_name"),  # the 40 movies
            F.col("p_partkey") == F.col("o_orderkey") % 40,
        )
    )
    price = F.col("o_totalprice")
    return joined.select(
        F.concat(F.lit("tt"), F.col("p_partkey").cast("string")).alias("movie_id"),
        F.col("p_name").alias("movie_title"),
        review_id(F.col("doc_id")),
        F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("author"),
        (F.round(price).cast("bigint") % 10 + 1).cast("double").alias("author_rating"),
        (F.floor(price).cast("bigint") % 97).cast("int").alias("upvotes"),
        (F.col("o_custkey") % 23).cast("int").alias("downvotes"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("submission_date"),
        F.substring_index("text", "\n", 1).alias("summary"),
        F.col("text").alias("content"),
        "doc_id",
    )


def review_id(doc_id: Column) -> Column:
    return F.concat(F.lit("rw"), doc_id.cast("string")).alias("review_id")


def raw_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews with holes, and with a second, changed copy of every tenth row."""
    base = reviews(spark, d).withColumn("copy_no", F.lit(0))
    again = base.filter("doc_id % 10 = 0").withColumns(
        {"copy_no": F.lit(1), "upvotes": F.col("upvotes") + 1, "summary": F.lit("again")}
    )
    every = lambda n: F.col("doc_id") % n == 0
    null_at = {"author_rating": 17, "upvotes": 23, "submission_date": 29, "summary": 31, "author": 37}
    holes = {c: F.when(~every(n), F.col(c)) for c, n in null_at.items()}
    blank = F.when(every(19), F.lit("\n  \r")).otherwise(F.col("content"))
    half = F.when(every(41), F.lit(7.5)).otherwise(holes["author_rating"])
    return base.unionByName(again).withColumns({**holes, "content": blank, "author_rating": half})


def all_titles(spark: SparkSession, d: str) -> DataFrame:
    """Every part as a title; most have no review."""
    return table(spark, d, "part").select(
        F.concat(F.lit("tt"), F.col("p_partkey").cast("string")).alias("movie_id"),
        F.col("p_name").alias("movie_title"),
    )


def movies(spark: SparkSession, d: str) -> DataFrame:
    """The titles that reviews are about."""
    part = table(spark, d, "part").filter("p_partkey < 40")
    return part.select(
        F.concat(F.lit("tt"), F.col("p_partkey").cast("string")).alias("movie_id"), F.col("p_name").alias("movie_title")
    )


def docs(spark: SparkSession, d: str) -> DataFrame:
    return to_index_docs(reviews(spark, d))


def response_pages(spark: SparkSession, d: str) -> DataFrame:
    """Saved pages: (movie_id, page_no, body); one page holds errors."""
    r = reviews(spark, d).withColumn("page_no", F.floor(F.col("doc_id") / PAGE_SPAN))
    node = F.struct(
        F.col("review_id").alias("id"),
        F.when(F.col("downvotes") != 5, F.struct(F.col("author").alias("nickName"))).alias("author"),
        F.col("author_rating").alias("authorRating"),
        F.when(
            F.col("downvotes") != 6, F.struct(F.col("upvotes").alias("upVotes"), F.col("downvotes").alias("downVotes"))
        ).alias("helpfulness"),
        F.col("submission_date").alias("submissionDate"),
        F.when(
            F.col("downvotes") != 7, F.struct(F.struct(F.col("content").alias("plainText")).alias("originalText"))
        ).alias("text"),
        F.struct(F.col("summary").alias("originalText")).alias("summary"),
    )
    last = r.agg(F.max("page_no")).scalar()
    pages = r.groupBy("movie_id", "page_no").agg(F.collect_list(F.struct(node.alias("node"))).alias("edges"))
    more = F.col("page_no") < last
    info = F.struct(
        more.alias("hasNextPage"),
        F.when(more, F.concat_ws("-", "movie_id", F.col("page_no").cast("string"))).alias("endCursor"),
    )
    errors = F.when(
        (F.col("movie_id") == "tt3") & (F.col("page_no") == 0), F.array(F.struct(F.lit("timed out").alias("message")))
    )
    body = F.to_json(
        F.struct(
            F.struct(F.struct(F.struct("edges", info.alias("pageInfo")).alias("reviews")).alias("title")).alias("data"),
            errors.alias("errors"),
        )
    )
    return pages.select("movie_id", "page_no", body.alias("body"))


def combined(spark: SparkSession, d: str) -> DataFrame:
    """Reviews with ``text``, summary and content together."""
    return reviews(spark, d).withColumn("text", combine_text(F.col("summary"), F.col("content")))


def title_mentions(spark: SparkSession, d: str) -> DataFrame:
    """Review texts that end with a sentence about one or two titles."""
    r = reviews(spark, d).withColumn("other_id", F.concat(F.lit("tt"), ((F.col("doc_id") + 1) % 40).cast("string")))
    other = movies(spark, d).toDF("other_id", "other_title")
    named = (
        F.when(F.col("doc_id") % 3 == 0, F.col("movie_title"))
        .when(F.col("doc_id") % 3 == 1, F.col("other_title"))
        .otherwise(F.concat_ws(" and ", "movie_title", "other_title"))
    )
    text = F.concat("content", F.lit(". I saw "), named, F.lit(". The end."))
    return r.join(other, "other_id").select("review_id", "movie_title", text.alias("text"))


def pairs(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    return spark.createDataFrame(rows, names)


def slang(spark: SparkSession) -> DataFrame:
    schema = "term string, expansion string"
    return merge_dictionaries(pairs(spark, GENERAL_SLANG, schema), pairs(spark, DOMAIN_SLANG, schema))


def lemmas(spark: SparkSession) -> DataFrame:
    return pairs(spark, LEMMAS, "word string, lemma string")


def stop_words(spark: SparkSession) -> DataFrame:
    return pairs(spark, [(w,) for w in STOP_WORDS], "word string")


def aliases(spark: SparkSession) -> DataFrame:
    return pairs(spark, ALIASES, "alias string, movie_title string")


def entities(spark: SparkSession, d: str) -> DataFrame:
    """Long words of the whole text as entities, in three label classes."""
    found = documents(spark, d).select(
        review_id(F.col("doc_id")),
        F.posexplode(F.regexp_extract_all("text", F.lit(r"\p{L}{7,}"), 0)).alias("pos", "word"),
    )
    label = F.element_at(F.array(F.lit("PERSON"), F.lit("ORG"), F.lit("GPE")), F.col("pos") % 3 + 1)
    value = F.when(F.col("pos") % 5 == 0, F.concat_ws(" ", F.col("word"), F.lit("Jr"))).otherwise(F.col("word"))
    return found.select("review_id", "pos", label.alias("label"), value.alias("value"))


def truth(spark: SparkSession, d: str) -> DataFrame:
    """(review_id, doc_id, polarity 0/1, toxic)."""
    return table(spark, d, "labels").select(
        review_id(F.col("doc_id")), "doc_id", F.col("quality").alias("polarity"), "toxic"
    )


def annotators(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Three label tables: a is right, b turns some labels, c is undecided on some."""
    base = truth(spark, d).join(reviews(spark, d).drop("doc_id"), "review_id")
    name = lambda n: F.when(n == 1, "Positive").otherwise(" NEGATIVE ")
    own = {
        "a": (F.when(F.col("toxic") == 1, "objective").otherwise("subjective"), name(F.col("polarity"))),
        "b": (
            F.lit("Subjective"),
            F.when(F.col("doc_id") % 17 == 0, F.lit("nan"))
            .when(F.col("doc_id") % 11 == 0, name(1 - F.col("polarity")))
            .otherwise(name(F.col("polarity"))),
        ),
        "c": (
            F.when(F.col("doc_id") % 19 == 0, F.lit("Objective ")).otherwise("subjective"),
            F.when(F.col("doc_id") % 13 == 0, F.lit("neutral")).otherwise(name(F.col("polarity"))),
        ),
    }
    columns = ["review_id", "movie_id", "movie_title", "author_rating", "submission_date", "summary", "content"]
    return {
        who: base.select(
            *columns,
            subjective.alias("subjective_label"),
            polarity.alias("polarity_label"),
            F.lit("").alias("Notes"),
        )
        for who, (subjective, polarity) in own.items()
    }


def predictions(spark: SparkSession, d: str) -> DataFrame:
    """Two models on two text sources over the labelled documents."""
    base = truth(spark, d).select("review_id", "doc_id", "polarity")
    per_model = F.array(
        *[
            F.struct(
                F.lit(source).alias("text_source"),
                F.lit(model).alias("model"),
                F.when(F.col("doc_id") % n == 0, 1 - F.col("polarity")).otherwise(F.col("polarity")).alias("predicted"),
            )
            for source, model, n in WRONG
        ]
    )
    long = base.select("review_id", "polarity", F.inline(per_model))
    return long.withColumn("predicted_label", F.when(F.col("predicted") == 1, "POSITIVE").otherwise("NEGATIVE"))


def irony(spark: SparkSession, d: str) -> DataFrame:
    """(review_id, label, score); every eleventh score is missing."""
    return table(spark, d, "documents").select(
        review_id(F.col("doc_id")),
        F.when(F.col("doc_id") % 4 == 0, "Irony").otherwise("non_irony").alias("label"),
        F.when(F.col("doc_id") % 11 != 0, (F.col("doc_id") % 100) / 100.0).alias("score"),
    )


def timed_summary(spark: SparkSession, summary: DataFrame) -> DataFrame:
    times = pairs(spark, TIMES, "text_source string, model string, classification_time_seconds double")
    return summary.join(F.broadcast(times), ["text_source", "model"])


def stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)
