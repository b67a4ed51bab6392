import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marquee import session
from marquee.operators import models as mo
from marquee.operators.clean import to_index_docs
from marquee.operators.titles import title_keys
from marquee.plans import corpus, evaluation, experiments
from marquee.schema import REVIEW_SCHEMA

GOOD, BAD = "great lovely fine plot", "awful boring poor plot"


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [
        ("m1", "One", f"r{i}", "a", float(i % 10 + 1), i, 1, f"20{10 + i % 9}-05-05", "s", GOOD if i % 3 else BAD)
        for i in range(90)
    ]
    return spark.createDataFrame(rows, REVIEW_SCHEMA).persist()


def test_label_train_score_and_search(spark, reviews):
    texts = reviews.withColumn("preprocessed_text", F.col("content"))
    voted = texts.withColumn(
        "ground_truth_polarity",
        F.when(F.col("review_id") == "r1", "NEUTRAL").when(F.col("content") == GOOD, "POSITIVE").otherwise("NEGATIVE"),
    )
    split = evaluation.split_evaluation_set(voted).persist()
    assert split.count() == 89
    done = mo.evaluate_sources(
        split.filter("split = 'train'"), split.filter("split = 'test'"), ["preprocessed_text"], (mo.LOGISTIC, mo.UNIFORM)
    )
    trained, best = evaluation.best_trained(done, "preprocessed_text")
    assert best == mo.LOGISTIC

    test = texts.withColumn("ground_truth", F.when(F.col("author_rating") > 5, "positive"))
    predictions, summary = evaluation.score_test_set(test, trained, best)
    row = summary.first()
    assert (predictions.count(), row.rows_scored, row.model) == (90, 90, mo.LOGISTIC)
    assert 0 < row.accuracy <= 1

    labelled = corpus.label_index_docs(to_index_docs(reviews), texts, trained, best)
    assert {(r.content, r.sentiment) for r in labelled.collect()} == {(GOOD, "POSITIVE"), (BAD, "NEGATIVE")}
    facet = experiments.search_experiments(labelled, "one", "plot", "plot", "plot", {"all": None})["sentiment"]
    assert [tuple(r) for r in facet.collect()] == [("POSITIVE", 60), ("NEGATIVE", 30)]


def test_experiments_are_written_as_json(spark, reviews, tmp_path):
    windows = {"all": None, "early": ("2010-01-01 00:00:00", "2011-12-31 23:59:59")}
    tables = experiments.search_experiments(to_index_docs(reviews), "one", "great", "poor", "plot", windows)
    experiments.write_experiments(tables, str(tmp_path / "report"))
    lines = lambda name: [json.loads(x) for f in Path(tmp_path / "report" / name).glob("*.json") for x in f.read_text().splitlines()]
    assert {r["label"]: r["num_found"] for r in lines("windows")} == {"all": 90, "early": 20}
    assert {r["label"]: r["num_found"] for r in lines("title_fields")} == {"exact_title": 0, "analysed_title": 90}
    assert {r["variant"] for r in lines("rankings")} == {"bm25", "by_helpfulness", "boosted"}
    assert lines("sentiment") == []


def test_sentences_go_before_cleaning(spark):
    df = spark.createDataFrame([("r1", "Up", "I like Up! Not Thor. brb")], "review_id string, movie_title string, text string")
    keys = title_keys(spark.createDataFrame([("Up",), ("Thor",)], "movie_title string"))
    slang = spark.createDataFrame([("brb", "be back")], "term string, expansion string")
    lemmas = spark.createDataFrame([("back", "Back")], "word string, lemma string")
    stops = spark.createDataFrame([("i",), ("not",)], "word string")
    out = corpus.preprocess_for_title(df, keys, slang, lemmas, stops)
    assert out.first().processed_text == "like up be back"


def test_shared_folder_is_the_sessions(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert session.shared_dir(spark) == (named or session.shared_dir(spark))
    stored = session.materialise(spark.range(5), "t")
    assert stored.count() == 5 and "FileScan" in stored._jdf.queryExecution().executedPlan().toString()
