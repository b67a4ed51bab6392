import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marquee.operators import groups
from marquee.operators.rows import attach_sentiment, attach_text, overlap_count, without
from marquee.operators.sample import equal_rating_sample, label_sample, stratified_split


def draw(seed, key):
    return hashlib.md5(f"{seed}:{key}".encode()).hexdigest(), key


def reviews(spark, counts):
    """counts: {(rating, title): rows}"""
    rows = []
    for (rating, title), n in counts.items():
        rows += [(f"r{len(rows) + i}", "tt", title, rating, "2020-01-01", "s", "c") for i in range(n)]
    names = "review_id string, movie_id string, movie_title string, author_rating int, submission_date string, summary string, content string"
    return spark.createDataFrame(rows, names), rows


def expected_sample(rows, total, seed=42):
    """The three steps in plain Python."""
    by_rating = defaultdict(lambda: defaultdict(list))
    for r in sorted(rows, key=lambda r: draw(seed, r[0])):
        by_rating[r[3]][r[2]].append(r[0])
    chosen = []
    for rating in range(1, 11):
        movies = by_rating.get(rating, {})
        pool = [x for m in movies.values() for x in m]
        target = min(total // 10, len(pool))
        picked = []
        for i, title in enumerate(sorted(movies)):
            quota = target // len(movies) + (1 if i < target % len(movies) else 0)
            picked += movies[title][:quota]
        rest = sorted((x for x in pool if x not in picked), key=lambda x: draw(seed, x))
        chosen += picked + rest[: target - len(picked)]
    others = sorted((r[0] for r in rows if r[0] not in set(chosen)), key=lambda x: draw(seed, x))
    return set(chosen + others[: total - len(chosen)])


CASES = {
    "hot cell": {(1, "a"): 400, (1, "b"): 1, (2, "c"): 3, (9, "a"): 30, (10, "z"): 12},
    "more movies than places": {(3, f"m{i:02d}"): 2 for i in range(30)} | {(4, "x"): 50},
    "fewer rows than asked": {(5, "a"): 3, (6, "b"): 4},
    "one of each": {(r, "t"): 10 for r in range(1, 11)},
}


@pytest.mark.parametrize("name", CASES)
def test_label_sample(spark, name):
    df, rows = reviews(spark, CASES[name])
    got = label_sample(df, total=100).collect()
    assert {r.review_id for r in got} == expected_sample(rows, 100)
    assert len(got) == min(100, len(rows))
    assert all((r.subjective_label, r.polarity_label, r.notes) == ("", "", "") for r in got)


def test_equal_rating_sample(spark):
    df, rows = reviews(spark, {(r, "t"): 6 + r for r in range(1, 11)})
    seen = df.filter("review_id = 'r0'")
    out = equal_rating_sample(df, seen, total=50)
    got = out.collect()
    assert Counter(r.author_rating for r in got) == {r: 5 for r in range(1, 11)}
    assert "r0" not in {r.review_id for r in got}
    want = {
        x for v in range(1, 11)
        for x in sorted((r[0] for r in rows if r[3] == v and r[0] != "r0"), key=lambda x: draw(99, x))[:5]
    }
    assert {r.review_id for r in got} == want
    assert [r.review_id for r in got] == sorted(want, key=lambda x: draw(100, x))


def test_equal_rating_sample_shortages(spark):
    df, _ = reviews(spark, {(r, "t"): (2 if r == 4 else 9) for r in range(1, 11)})
    none = df.limit(0)
    with pytest.raises(ValueError, match="evenly"):
        equal_rating_sample(df, none, total=55)
    with pytest.raises(ValueError, match="rating 4 has 2"):
        equal_rating_sample(df, none, total=50)
    with pytest.raises(ValueError, match="only 83"):
        equal_rating_sample(df, none, total=100)


def test_ratings_round_half_to_even(spark):
    rows = [("a", 0.5), ("b", 1.5), ("c", 2.5), ("d", 10.4), ("e", 10.6)]
    df = spark.createDataFrame(
        [(i, "t", "t", r, "s", "c") for i, r in rows],
        "review_id string, movie_id string, movie_title string, author_rating double, summary string, content string",
    )
    out = equal_rating_sample(df, df.limit(0), total=2, low=2, high=2)
    assert {r.review_id for r in out.collect()} == {"b", "c"}


def test_split_is_exact_on_a_hot_stratum(spark):
    sizes = {"hot": 5000, "b": 10, "c": 3, "d": 2, "single": 1}
    rows = [(f"{s}{i}", s if s != "c" else None) for s, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, "review_id string, stratum string")
    got = stratified_split(df, ["stratum"], 0.15, seed=7).collect()
    assert len(got) == len(rows)
    for s, n in sizes.items():
        ids = [r[0] for r in rows if r[0].startswith(s)]
        k = int(n * 0.15 + 0.5) if n > 1 else 0
        want = set(sorted(ids, key=lambda x: draw(7, x))[:k])
        assert {r.review_id for r in got if r.review_id in set(ids) and r.split == "test"} == want


def test_split_is_repeatable_under_other_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("review_id"), (F.col("id") % 3).alias("s"))
    one = stratified_split(df.repartition(3), ["s"]).filter("split = 'test'").select("review_id")
    two = stratified_split(df.coalesce(1), ["s"]).filter("split = 'test'").select("review_id")
    assert {r[0] for r in one.collect()} == {r[0] for r in two.collect()}


def test_group_limit_is_planned_on_both_sides(spark):
    df = spark.range(100).withColumn("g", F.col("id") % 2)
    plan = groups.top_per_group(df, ["g"], [F.col("id")], 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_large_k_goes_through_salted_groups(spark):
    df = spark.range(6000).withColumn("g", F.col("id") % 2)
    top = groups.top_per_group(df, ["g"], [F.col("id").desc()], 1500)
    assert {r.id for r in top.collect()} == set(range(3000, 6000))


def test_joins_keep_their_promise(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 0)], "review_id string, polarity int")
    texts = spark.createDataFrame([("a", "x"), ("c", "y"), (None, "z")], "review_id string, body string")
    with pytest.raises(Exception, match="no body for review_id b"):
        attach_text(rows, texts, "body").collect()
    assert attach_text(rows.limit(1), texts, "body").count() == 1
    assert [r.review_id for r in without(rows, texts).collect()] == ["b"]
    assert overlap_count(rows, texts.union(texts)).first().n_common == 1


def test_sentiment_join_adds_no_rows(spark):
    docs = spark.createDataFrame([("a", ""), ("b", "")], "id string, sentiment string")
    predictions = spark.createDataFrame(
        [("a", "m", "NEGATIVE"), ("a", "m", "POSITIVE"), ("b", "other", "POSITIVE")],
        "review_id string, model string, predicted_label string",
    )
    assert sorted(map(tuple, attach_sentiment(docs, predictions, "m").collect())) == [("a", "POSITIVE"), ("b", "")]
