import json

import pytest
from pyspark.sql import functions as F

from marquee.operators.clean import clean_reviews, to_index_docs, valid_ratings, with_row_ids
from marquee.schema import REVIEW_COLUMNS, REVIEW_SCHEMA
from marquee.sources import flatten_review_pages, page_status, read_reviews, upsert_reviews, write_table


def review(**changes):
    row = dict(
        movie_id="tt1", movie_title="One", review_id="r1", author="a", author_rating=8.0, upvotes=2, downvotes=4,
        submission_date="2019-04-05", summary="s", content="c",
    )
    return tuple({**row, **changes}[c] for c in REVIEW_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), REVIEW_SCHEMA)


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_written_tables_read_back(spark, tmp_path, fmt):
    rows = [
        review(content='two\nlines, "quoted", and a comma', summary='""'),
        review(review_id="r2", author_rating=None, upvotes=None, content="x"),
    ]
    path = str(tmp_path / f"t.{fmt}")
    write_table(frame(spark, *rows), path, fmt)
    back = read_reviews(spark, path)
    assert back.schema == REVIEW_SCHEMA
    assert sorted(map(tuple, back.collect()), key=lambda r: r[2]) == rows


def test_csv_blank_is_null_and_becomes_blank_text(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(",".join(REVIEW_COLUMNS) + "\ntt1,One,r1,,,,,,,words\n")
    row = to_index_docs(read_reviews(spark, str(path))).first()
    assert (row.author, row.author_rating, row.upvotes, row.helpfulness_score) == ("", 0.0, 0, 0.0)
    assert (row.submission_date, row.year, row.summary, row.sentiment) == (None, 0, "", "")


def test_limit_needs_an_order(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    write_table(frame(spark, *[review(review_id=f"r{i}") for i in range(5)]), path)
    with pytest.raises(ValueError, match="order_by"):
        read_reviews(spark, path, limit=2)
    kept = read_reviews(spark, path, limit=2, order_by=["review_id"], columns=["review_id"])
    assert [r.review_id for r in kept.collect()] == ["r0", "r1"]


def test_columns_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    write_table(frame(spark, review()), path)
    plan = read_reviews(spark, path, columns=["review_id", "content"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<review_id:string,content:string>" in plan


def page(edges, more=False, cursor=None, **top):
    reviews = {"edges": edges, "pageInfo": {"hasNextPage": more, "endCursor": cursor}}
    return json.dumps({"data": {"title": {"reviews": reviews}}, **top})


def pages(spark, *bodies):
    return spark.createDataFrame([("tt1", i, b) for i, b in enumerate(bodies)], "movie_id string, page_no int, body string")


def test_pages_survive_nulls_at_every_level(spark):
    full = {
        "id": "r1", "author": {"nickName": "n"}, "authorRating": 7, "helpfulness": {"upVotes": 1, "downVotes": 0},
        "submissionDate": "2020-01-02", "text": {"originalText": {"plainText": "t"}}, "summary": {"originalText": "s"},
    }
    holes = {**full, "id": "r2", "author": None, "helpfulness": None, "text": {"originalText": None}, "summary": None}
    movies = spark.createDataFrame([("tt1", "One")], "movie_id string, movie_title string")
    df = flatten_review_pages(pages(spark, page([{"node": full}, {"node": holes}, {"node": None}])), movies)
    rows = {r.review_id: r for r in df.collect()}
    assert (rows["r1"].content, rows["r1"].upvotes, rows["r1"].movie_title) == ("t", 1, "One")
    assert (rows["r2"].author, rows["r2"].upvotes, rows["r2"].content, rows["r2"].summary) == (None,) * 4
    assert rows[None].movie_id == "tt1"


def test_error_pages_and_unknown_movies(spark):
    movies = spark.createDataFrame([("tt9", "Nine")], "movie_id string, movie_title string")
    df = pages(spark, page([{"node": {"id": "r1"}}]), page([{"node": {"id": "r2"}}], errors=[{"message": "no"}]), "{}")
    assert [(r.review_id, r.movie_title) for r in flatten_review_pages(df, movies).collect()] == [("r1", None)]


def test_page_chain_ends_without_cursor(spark):
    df = page_status(pages(spark, page([], True, "c1"), page([], True, None), page([], False, "c3"), page([], errors=["x"])))
    found = {r.page_no: (r.has_next_page, r.end_cursor, r.is_last) for r in df.collect()}
    assert found == {0: (True, "c1", False), 1: (True, None, True), 2: (False, "c3", True)}


def test_newest_batch_replaces(spark):
    make = lambda *rows: spark.createDataFrame(list(rows), "id string, n int")
    out = upsert_reviews(make(("a", 1), ("b", 1)), make(("b", 9), ("b", 2), ("c", 2)), make(("c", 3)), tie_break=("n",))
    assert sorted(map(tuple, out.collect())) == [("a", 1), ("b", 2), ("c", 3)]


def test_clean_reviews(spark):
    df = frame(
        spark,
        review(content=" a\nb\r", summary=None),
        review(content="later", author="z"),
        review(review_id="r2", content=" \n "),
        review(review_id=None, content="kept"),
        review(review_id=None, content="zz kept too late"),
    )
    rows = clean_reviews(df, order_by=["author"]).collect()
    assert sorted((r.review_id or "", r.content, r.summary) for r in rows) == [("", "kept", "s"), ("r1", "a b", "")]


def test_valid_ratings(spark):
    df = frame(
        spark,
        review(),
        review(review_id="r2", author_rating=7.5),
        review(review_id="r3", author_rating=11.0),
        review(review_id="r4", author_rating=None),
        review(review_id="r5", content="\t\n"),
        review(review_id="r6", upvotes=None),
    )
    rows = valid_ratings(df).collect()
    assert [(r.review_id, r.author_rating) for r in rows] == [("r1", 8)]


def test_index_docs_values(spark):
    row = to_index_docs(frame(spark, review())).first()
    assert row.helpfulness_score == pytest.approx(2 / 7)
    assert (str(row.submission_date), row.year, row.id) == ("2019-04-05 00:00:00", 2019, "r1")


def test_short_and_odd_dates(spark):
    df = to_index_docs(frame(spark, review(submission_date="19"), review(submission_date="abcd-01-01")))
    assert [(r.submission_date, r.year) for r in df.collect()] == [(None, 0), (None, None)]


def test_row_ids_follow_the_order(spark):
    df = spark.range(1000).select((F.lit(999) - F.col("id")).alias("v")).repartition(7)
    rows = with_row_ids(df, ["v"]).collect()
    assert sorted(r.review_id for r in rows) == list(range(1000))
    assert all(r.review_id == r.v for r in rows)
    assert with_row_ids(rows_with_id := df.withColumnRenamed("v", "review_id"), ["review_id"]) is rows_with_id
