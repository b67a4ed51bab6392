import math
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import queries as cq
from marquee import session
from marquee.functions import counting, packing
from marquee.functions.analysis import ENGLISH, PLAIN
from marquee.functions.hashing import xxhash64
from marquee.operators import facets as fa
from marquee.operators import postings as po
from marquee.operators import search as se
from marquee.plans.corpus import index_reviews
from marquee.schema import REVIEW_SCHEMA

ROWS = [
    # movie_id, title, id, author, rating, up, down, date, summary, content
    ("m1", "Infinity War", "r1", "a", 9.0, 9, 0, "2019-01-01", "great war", "A masterpiece of war, a true masterpiece"),
    ("m1", "Infinity War", "r2", "b", 10.0, 0, 9, "2021-12-31", "meh", "war of the worlds is no masterpiece"),
    ("m2", "War Horse", "r3", "c", 1.0, 5, 5, "2022-01-01", "horse", "the horse and the war"),
    ("m3", "Endgame", "r4", "d", 4.0, None, None, None, None, "masterpieces everywhere. The end"),
    ("m3", "Endgame", "r5", "e", None, 1, 1, "2018-06-01", "", ""),
]


@pytest.fixture(scope="module")
def docs(spark):
    from marquee.operators.clean import to_index_docs

    return to_index_docs(spark.createDataFrame(ROWS, REVIEW_SCHEMA)).persist()


@pytest.fixture(scope="module", params=["plain", "english"])
def index(spark, request, tmp_path_factory):
    analyzer = {"plain": PLAIN, "english": ENGLISH}[request.param]
    path = str(tmp_path_factory.mktemp("index") / request.param)
    return index_reviews(spark.createDataFrame(ROWS, REVIEW_SCHEMA), path, analyzer)


def bm25(tf, length, mean, n, df):
    return math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf / (tf + 1.2 * (0.25 + 0.75 * length / mean))


def ids(df):
    return [r.id for r in df.collect()]


def test_bm25_by_hand(docs):
    rows = se.search(docs, se.SearchRequest("masterpiece", ("content",))).collect()
    mean = (7 + 7 + 5 + 4) / 4  # the blank text does not count as a document
    want = {"r1": bm25(2, 7, mean, 4, 2), "r2": bm25(1, 7, mean, 4, 2)}
    assert {r.id: r.score for r in rows} == {i: pytest.approx(s, abs=1e-6) for i, s in want.items()}
    assert rows[0].id == "r1"


REQUESTS = [
    se.SearchRequest("masterpiece"),
    se.SearchRequest("infinity war war", k=3),
    se.SearchRequest("war masterpiece", ("content",), sort="helpfulness_score"),
    se.SearchRequest("war", sort="submission_date"),
    se.SearchRequest("war", sort="author_rating", min_rating=2),
    se.SearchRequest("war", boost="helpfulness_score"),
    se.SearchRequest("the war", ("content",), phrase=True),
    se.SearchRequest("war of the worlds", ("content",), phrase=True),
    se.SearchRequest("war", movie="war infinity"),
    se.SearchRequest("war", title="War Horse"),
    se.SearchRequest("war", start_year=2019, end_year=2021),
    se.SearchRequest("masterpiece", max_rating=9.5),
    se.SearchRequest("nosuchword"),
    se.SearchRequest("  "),
]


@pytest.mark.parametrize("request_", REQUESTS, ids=range(len(REQUESTS)))
def test_documents_and_index_agree(index, request_):
    scan = se.search(index.docs, request_, index.analyzer)
    stored = se.search_index(index, request_)
    assert scan.columns == stored.columns
    assert scan.collect() == stored.collect()
    matched = se.matching(index.docs, request_, index.analyzer)
    assert sorted(ids(matched)) == sorted(ids(se.matching_index(index, request_)))


def test_filters_do_not_change_scores(docs):
    plain = {r.id: r.score for r in se.search(docs, se.SearchRequest("war")).collect()}
    some = {r.id: r.score for r in se.search(docs, se.SearchRequest("war", min_rating=9)).collect()}
    assert some and all(plain[i] == s for i, s in some.items())


def test_request_parts(docs):
    find = lambda *a, **k: sorted(ids(se.search(docs, se.SearchRequest(*a, **k))))
    assert find("war", movie="war infinity") == ["r1", "r2"]
    assert find("war", title="War Horse") == ["r3"]
    assert find("war", start_year=2019, end_year=2021) == ["r1", "r2"]
    assert find("war", end="2021-12-31 00:00:00", start="2020-01-01 00:00:00") == ["r2"]
    assert find("masterpieces") == ["r4"]
    assert find("war horse", ("content",), phrase=True) == []
    assert find("") == []
    with pytest.raises(ValueError, match="sort"):
        se.SearchRequest("x", sort="upvotes")
    with pytest.raises(ValueError, match="unknown fields"):
        se.SearchRequest("x", ("author",))


def test_english_finds_word_forms_and_keeps_gaps(docs):
    found = lambda q, **k: sorted(ids(se.search(docs, se.SearchRequest(q, ("content",), **k), ENGLISH)))
    assert found("masterpiece") == ["r1", "r2", "r4"]
    assert found("horse and the war", phrase=True) == ["r3"]
    assert found("horse war", phrase=True) == []
    assert found("the") == []


def test_empty_corpus_and_empty_field(docs):
    assert se.search(docs.limit(0), se.SearchRequest("war")).collect() == []
    no_summary = docs.withColumn("summary", F.lit(""))
    rows = se.search(no_summary, se.SearchRequest("war", ("summary", "content"))).collect()
    assert {r.id for r in rows} == {"r1", "r2", "r3"}


def test_result_row_shape(docs):
    row = se.search(docs, se.SearchRequest("masterpieces")).first()
    assert (row.date, row.summary, row.author_rating, row.upvotes) == ("", "", 4.0, 0)
    assert row.snippet == "masterpieces everywhere. The end"


def test_postings_of_every_field(docs):
    rows = {(r.field, r.term, r.id): (r.tf, r.positions, r.field_len) for r in po.build_postings(docs).collect()}
    assert rows[("content", "masterpiece", "r1")] == (2, [1, 6], 7)
    assert rows[("movie_title_t", "infinity", "r2")] == (1, [0], 2)
    assert not [k for k in rows if k[2] == "r5" and k[0] == "content"]
    english = {(r.field, r.term, r.id): r.positions for r in po.build_postings(docs, analyzer=ENGLISH).collect()}
    assert english[("content", "war", "r3")] == [4] and ("content", "the", "r3") not in english


def test_steps_and_batches_cut_no_posting(monkeypatch):
    lists = pa.array([["b", "a", "b"], None, [], ["a", None, "c", "a"], ["d"] * 9], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([pa.array(["x", "y", "z", "x", None]), lists], names=["id", "w"])
    rows = lambda b: [r for found in po._field_postings("f", b.column("id"), b.column("w")) for r in found.to_pylist()]
    whole = rows(batch)
    assert [(r["term"], r["id"], r["positions"], r["field_len"], r["lead"]) for r in whole] == [
        ("a", "x", [1], 3, True), ("a", "x", [0, 3], 3, True), ("b", "x", [0, 2], 3, False), ("c", "x", [2], 3, False),
        ("d", None, list(range(9)), 9, True),
    ]
    monkeypatch.setattr(po, "POSTINGS_PER_BATCH", 2)
    assert rows(batch) == whole
    monkeypatch.setattr(counting, "STEP_WORDS", 4)
    parts = list(counting.steps(batch, ["w"]))
    assert [p.num_rows for p in parts] == [4, 1] and pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    by_part = [r for p in parts for r in rows(p)]
    assert sorted(map(repr, by_part)) == sorted(map(repr, whole))


def test_postings_agree_with_counting_by_hand(spark):
    texts = [" ".join(f"w{(i * j) % 13}" for j in range(i % 9)) for i in range(60)]
    rows = [(f"d{i % 50}" if i % 11 else None, t if i % 7 else None) for i, t in enumerate(texts)]
    built = po.build_postings(spark.createDataFrame(rows, "id string, content string"), {"content": "content"})
    want = []
    for id_, text in rows:
        words = (text or "").split()
        for term in set(words):
            places = [p for p, w in enumerate(words) if w == term]
            want.append(("content", term, id_, len(places), places, len(words), term == min(words)))
    assert sorted(map(repr, map(tuple, built.collect()))) == sorted(map(repr, want))
    plan = built._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "lambda" not in plan and "Exchange" not in plan


def test_every_file_of_a_bucket_is_used(spark, tmp_path):
    docs = spark.range(600).select(
        F.format_string("d%05d", "id").alias("id"), F.lit("").alias("summary"), F.lit("t").alias("movie_title"),
        F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: F.concat(F.lit("w"), i))).alias("content"),
    )
    po.write_index(docs, str(tmp_path / "i"), buckets=5, files_per_bucket=4)
    for table in ("postings", "docs"):
        files = spark.read.parquet(str(tmp_path / "i" / table)).select("bucket", F.input_file_name().alias("f")).distinct()
        assert {r["count"] for r in files.groupBy("bucket").count().collect()} == {4}


def test_exact_and_analysed_title(docs):
    rows = {r.label: r.num_found for r in se.exact_and_analysed_title(docs, "infinity war").collect()}
    assert rows == {"exact_title": 0, "analysed_title": 3}


def test_rankings_side_by_side(docs):
    rows = {r.variant: r for r in se.compare_rankings(docs, se.SearchRequest("war", ("content",)), top_n=1).collect()}
    assert rows["by_helpfulness"].avg_helpfulness_top_n == pytest.approx(0.9)
    assert {r.num_found for r in rows.values()} == {3}


def test_facets(docs):
    hits = se.matching(docs, se.SearchRequest("war", ("content",)))
    assert [tuple(r) for r in fa.facet_field(hits, "movie_title").collect()] == [("Infinity War", 2), ("War Horse", 1)]
    everything = fa.facet_field(hits, "movie_title", mincount=0, corpus=docs)
    assert [tuple(r) for r in everything.collect()][-1] == ("Endgame", 0)
    with pytest.raises(ValueError, match="corpus"):
        fa.facet_field(hits, "movie_title", mincount=0)
    assert fa.facet_field(hits, "sentiment").count() == 0
    many = fa.facet_many(hits, ["movie_title", "year", "sentiment"], limit=1)
    assert sorted(map(tuple, many.collect())) == [("movie_title", "Infinity War", 2), ("year", "2019", 1)]


def test_range_facet_leaves_the_end_out(docs):
    rows = [tuple(r) for r in fa.facet_range(docs, "author_rating").orderBy("bucket_start").collect()]
    assert rows == [(1.0, 4.0, 1), (4.0, 7.0, 1), (7.0, 10.0, 1)]
    rows = [tuple(r) for r in fa.facet_range(docs, "author_rating", include_upper=True).orderBy("bucket_start").collect()]
    assert rows[-1] == (7.0, 10.0, 2)
    uneven = [tuple(r) for r in fa.facet_range(docs, "author_rating", 1, 9, 5).orderBy("bucket_start").collect()]
    assert uneven == [(1.0, 6.0, 2), (6.0, 9.0, 0)]


def test_windows(docs):
    windows = {"all": None, "y": ("2019-01-01 00:00:00", "2021-12-31 00:00:00")}
    hits = se.matching(docs, se.SearchRequest("war", ("content",)))
    assert {r.label: r.num_found for r in se.count_windows(hits, windows).collect()} == {"all": 3, "y": 2}


def test_scan_plan_shuffles_only_numbers(docs, spark, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    stored = spark.read.parquet(str(tmp_path / "docs"))
    plan = se.search(stored, se.SearchRequest("war", ("content",), min_rating=2))._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "hashpartitioning" not in plan and "Python" not in plan
    assert plan.count("Exchange") == 1  # the statistics' single row
    assert "GreaterThanOrEqual(author_rating,2.0)" in plan


def test_index_reads_only_its_buckets(spark, tmp_path):
    index = index_reviews(spark.createDataFrame(ROWS, REVIEW_SCHEMA), str(tmp_path / "i"))
    scores = se._index_scores(index, se._query_of(se.SearchRequest("war", ("content",)), PLAIN))
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(field,content)" in plan and "EqualTo(term,war)" in plan
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ = \d+", plan)
    assert "positions" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    plan = se.search_index(index, se.SearchRequest("war", ("content",)))._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN ", plan) and "In(id, [" in plan


def test_many_results_are_joined_instead_of_fetched(spark, tmp_path, monkeypatch):
    index = index_reviews(spark.createDataFrame(ROWS, REVIEW_SCHEMA), str(tmp_path / "i"))
    request = se.SearchRequest("war masterpiece", sort="helpfulness_score")
    fetched = se.search_index(index, request).collect()
    monkeypatch.setattr(se, "FETCH_ROWS", 1)
    assert se.search_index(index, request).collect() == fetched


def test_common_term_spreads_over_index_files(spark, tmp_path):
    docs = spark.range(4000).select(
        F.format_string("d%05d", "id").alias("id"), F.lit("").alias("summary"), F.lit("war").alias("content"), F.lit("t").alias("movie_title")
    )
    po.write_index(docs, str(tmp_path / "i"), buckets=3, files_per_bucket=4)
    postings = spark.read.parquet(str(tmp_path / "i" / "postings"))
    assert postings.count() == 8000
    assert postings.filter("term = 'war'").select(F.input_file_name()).distinct().count() > 1
    assert {tuple(r) for r in po.load_index(spark, str(tmp_path / "i")).stats.collect()} == {
        ("content", 4000, 4000), ("movie_title_t", 4000, 4000),
    }


def index_docs(spark):
    rows = [("d1", "Running shoes", 1999), ("d2", "a runner runs", 2001), ("d3", "nothing", 2003)]
    df = spark.createDataFrame(rows, "id string, content string, y int")
    empty = {c: F.lit("x") for c in ("summary", "movie_title", "author", "sentiment")}
    numbers = {c: F.lit(1.0) for c in ("author_rating", "upvotes", "downvotes", "helpfulness_score")}
    dates = {"submission_date": F.make_timestamp(F.col("y"), F.lit(6), F.lit(1), F.lit(0), F.lit(0), F.lit(0))}
    return df.withColumns({**empty, **numbers, **dates}).drop("y")


def test_an_index_remembers_its_analyser(spark, tmp_path):
    po.write_index(index_docs(spark), str(tmp_path / "i"), ENGLISH)
    request = se.SearchRequest("running", ("content",))
    assert [r.id for r in se.search_index(po.load_index(spark, str(tmp_path / "i")), request).collect()] == ["d1", "d2"]
    assert {r.id for r in se.search_index(po.load_index(spark, str(tmp_path / "i"), ENGLISH), request).collect()} == {"d1", "d2"}
    with pytest.raises(ValueError, match="english"):
        po.load_index(spark, str(tmp_path / "i"), PLAIN)


def test_an_index_refuses_blank_ids(spark, tmp_path):
    docs = index_docs(spark).withColumn("id", F.when(F.col("id") != "d2", F.col("id")).otherwise(F.lit(" ")))
    with pytest.raises(Exception, match="has no id"):
        po.write_index(docs, str(tmp_path / "i"))


def test_all_date_bounds_hold(spark):
    request = se.SearchRequest("x", ("summary",), start_year=2000, start="1990-01-01 00:00:00", end_year=2005, end="2002-01-01 00:00:00")
    assert [r.id for r in se.search(index_docs(spark), request).collect()] == ["d2"]


def test_word_hashes_are_sparks(spark):
    draw = random.Random(3)
    words = ["", *["".join(draw.choice("abcé漢😀") for _ in range(n)) for n in range(70) for _ in range(3)]]
    rows = spark.createDataFrame([(w,) for w in words], "w string")
    rows = rows.select("w", F.xxhash64("w").alias("one"), F.xxhash64(F.lit("content"), "w").alias("two")).collect()
    found = pa.array(["x", *[r.w for r in rows]])[1:]
    assert xxhash64(found).tolist() == [r.one for r in rows]
    assert xxhash64(found, "content").tolist() == [r.two for r in rows]
    assert len(xxhash64(pa.array([], pa.string()))) == 0


def test_packed_numbers_come_back():
    arrays = [[], [0], [255, 256, 1], [1 << 16, 3], [1 << 40], [7] * 1000]
    data = packing.packed([np.array(a, dtype=np.int64) for a in arrays])
    assert [a.tolist() for a in packing.unpacked(data, len(arrays))] == arrays and len(data) < 150


@pytest.mark.parametrize("analyzer", [PLAIN, ENGLISH], ids=["plain", "english"])
@pytest.mark.parametrize("buckets, files", [(1, 1), (5, 4), (40, 7)])
def test_packed_postings_come_back(spark, analyzer, buckets, files):
    text = lambda i: " ".join(f"é{(i * j) % 13}" for j in range(i % 9)) if i % 7 else None
    rows = [(f"d{i % 50}", text(i), "the runs the" if i % 5 else "", "T U" if i % 3 else None) for i in range(160)]
    docs = spark.createDataFrame(rows, "id string, content string, summary string, movie_title string").repartition(3)
    blocks = po.packed_postings(docs, analyzer, buckets, files).persist()
    back, built = po.unpacked_postings(blocks), po.build_postings(docs, analyzer=analyzer)
    shown = lambda df: sorted(map(repr, df.drop("lead").collect()))
    assert back.schema == built.schema and shown(back) == shown(built)
    assert sorted(po.field_stats(back).collect()) == sorted(po.field_stats(built).collect())
    own = po.bucket_of(buckets, F.col("field"), F.col("term")) * files + F.pmod(F.xxhash64("id"), F.lit(files))
    dealt = {r.deal for r in blocks.collect()}
    assert {r.own for r in built.select(own.alias("own")).distinct().collect()} == dealt


def shuffle_files(spark):
    held = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return set(re.findall(r"shuffle_[\w.]+", held))


def test_building_an_index_leaves_no_shuffle_and_reads_documents_once(spark, tmp_path):
    seen, before, setting = spark.sparkContext.accumulator(0), shuffle_files(spark), spark.conf.get(session.DROP_SHUFFLES, None)

    def read(text):
        seen.add(1)
        return text

    docs = spark.range(300).select(
        F.format_string("d%05d", "id").alias("id"), F.lit("s").alias("summary"), F.lit("t").alias("movie_title"),
        F.udf(read, "string")(F.concat_ws(" ", F.lit("war"), "id")).alias("content"),
    )
    po.write_index(docs, str(tmp_path / "i"), buckets=3)
    assert seen.value == 300
    assert shuffle_files(spark) - before == set()
    assert spark.conf.get(session.DROP_SHUFFLES, None) == setting
    assert ids(se.matching_index(po.load_index(spark, str(tmp_path / "i")), se.SearchRequest("17", ("content",)))) == ["d00017"]


def test_appending_adds_the_new_postings_alone(spark, tmp_path):
    docs = index_docs(spark)
    po.write_index(docs.filter("id < 'd3'"), str(tmp_path / "i"), buckets=3)
    po.write_index(docs.filter("id >= 'd3'"), str(tmp_path / "i"), mode="append", buckets=3)
    rows = lambda df: sorted(map(repr, df.select("field", "term", "id", "tf", "positions", "field_len").collect()))
    assert rows(spark.read.parquet(str(tmp_path / "i" / "postings"))) == rows(po.build_postings(docs))


def test_index_queries_leave_no_index(spark, tmp_path):
    d = str(tmp_path)
    spark.range(60).select(
        F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("worthless of the"), F.col("id") % 7, F.lit("\nplate")).alias("text")
    ).write.parquet(f"{d}/documents.parquet")
    spark.range(80).selectExpr(
        "id o_orderkey", "id % 9 o_custkey", "id * 1.5D o_totalprice", "timestamp'1996-02-03 00:00:00' o_orderdate"
    ).write.parquet(f"{d}/orders.parquet")
    spark.range(50).selectExpr("id p_partkey", "concat('red plate ', id % 4) p_name").write.parquet(f"{d}/part.parquet")
    folder = f"{session.shared_dir(spark).removeprefix('file:')}/marquee/{spark.sparkContext.applicationId}"
    held = lambda: {f for f in os.listdir(folder) if f.startswith("index-")} if os.path.isdir(folder) else set()
    before = held()
    for stored, scanned in ((cq.index_bm25, cq.search_bm25), (cq.index_facets, cq.facet_multi), (cq.index_windows, cq.date_windows)):
        rows = sorted(map(tuple, stored(spark, d).collect()))
        assert rows and rows == sorted(map(tuple, scanned(spark, d).collect()))
        assert held() == before
