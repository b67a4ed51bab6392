"""Explicit schemas.  Nothing in the library infers a schema from data."""

from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType(
    [
        T.StructField("movie_id", T.StringType()),
        T.StructField("movie_title", T.StringType()),
        T.StructField("review_id", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("author_rating", T.DoubleType()),
        T.StructField("upvotes", T.IntegerType()),
        T.StructField("downvotes", T.IntegerType()),
        T.StructField("submission_date", T.StringType()),
        T.StructField("summary", T.StringType()),
        T.StructField("content", T.StringType()),
    ]
)

REVIEW_COLUMNS = REVIEW_SCHEMA.fieldNames()

# One saved response: data.title.reviews.{edges[].node, pageInfo}, or errors.
_NODE = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("author", T.StructType([T.StructField("nickName", T.StringType())])),
        T.StructField("authorRating", T.DoubleType()),
        T.StructField(
            "helpfulness",
            T.StructType(
                [
                    T.StructField("upVotes", T.IntegerType()),
                    T.StructField("downVotes", T.IntegerType()),
                ]
            ),
        ),
        T.StructField("submissionDate", T.StringType()),
        T.StructField(
            "text",
            T.StructType(
                [
                    T.StructField(
                        "originalText",
                        T.StructType([T.StructField("plainText", T.StringType())]),
                    )
                ]
            ),
        ),
        T.StructField("summary", T.StructType([T.StructField("originalText", T.StringType())])),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField(
            "data",
            T.StructType(
                [
                    T.StructField(
                        "title",
                        T.StructType(
                            [
                                T.StructField(
                                    "reviews",
                                    T.StructType(
                                        [
                                            T.StructField(
                                                "edges",
                                                T.ArrayType(
                                                    T.StructType([T.StructField("node", _NODE)])
                                                ),
                                            ),
                                            T.StructField(
                                                "pageInfo",
                                                T.StructType(
                                                    [
                                                        T.StructField("hasNextPage", T.BooleanType()),
                                                        T.StructField("endCursor", T.StringType()),
                                                    ]
                                                ),
                                            ),
                                        ]
                                    ),
                                )
                            ]
                        ),
                    )
                ]
            ),
        ),
        # Kept as raw JSON text: only its presence matters.
        T.StructField("errors", T.StringType()),
    ]
)
