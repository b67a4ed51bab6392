import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import features as ft
from marquee.operators import models as mo
from marquee.operators.sample import stratified_split

TEXTS = [("r1", "Good good film"), ("r2", "good day a day"), ("r3", "bad film, bad"), ("r4", None)]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(TEXTS, "review_id string, text string")


def test_vocabulary_counts_words_and_pairs(texts):
    rows = [tuple(r) for r in ft.vocabulary(texts, "text", min_df=1).collect()]
    # One-letter words go before pairs are made, hence "day day".
    assert rows[:4] == [("good", 3, 2), ("bad", 2, 1), ("day", 2, 1), ("film", 2, 2)]
    assert ("day day", 1, 1) in rows and ("good good", 1, 1) in rows
    assert [r[0] for r in ft.vocabulary(texts, "text").collect()] == ["good", "film"]
    assert [r[0] for r in ft.vocabulary(texts, "text", max_features=2, min_df=1).collect()] == ["good", "bad"]


@pytest.mark.parametrize("max_features, min_df", [(1, 1), (3, 1), (5, 1), (4, 2), (100, 2), (100, 1)])
def test_counting_pairs_of_frequent_words_loses_none(spark, monkeypatch, max_features, min_df):
    rows = [(" ".join(f"w{(i * k) % 7} v{(i + k) % 5}" for k in range(1, 9)),) for i in range(40)]
    df = spark.createDataFrame(rows, "text string")
    pruned = ft.vocabulary(df, "text", max_features, min_df).collect()
    monkeypatch.setattr(ft, "FREQUENT_WORDS", 1)
    assert pruned == ft.vocabulary(df, "text", max_features, min_df).collect()


def test_tfidf_by_hand(texts):
    rows = {(r.review_id, r.term): r.weight for r in ft.tfidf_terms(texts, "text").collect()}
    idf = math.log(5 / 3) + 1
    assert rows == {
        ("r1", "good"): pytest.approx(2 * idf / math.hypot(2 * idf, idf)),
        ("r1", "film"): pytest.approx(idf / math.hypot(2 * idf, idf)),
        ("r2", "good"): pytest.approx(1.0),
        ("r3", "film"): pytest.approx(1.0),
    }


def test_two_vocabularies_side_by_side(spark):
    df = spark.createDataFrame(
        [("r1", "aa bb", "ENTLBL_X"), ("r2", "aa bb", "ENTLBL_X"), ("r3", "aa", "")],
        "review_id string, preprocessed_text string, ner_text string",
    )
    fitted = ft.fit_source_features(df, "augmented_text")
    sizes = {len(r.features) for r in fitted.transform(df).collect()}
    assert sizes == {3 + 1}


def test_fused_vector_takes_each_rows_own_irony(texts):
    irony = texts.sparkSession.createDataFrame(
        [("r1", "IRONY", 0.75), ("r2", "non_irony", 0.25), ("r3", None, None)],
        "review_id string, label string, score double",
    )
    fitted = ft.fit_vectorizer(texts, "text")
    rows = {r.review_id: r.fused.toArray() for r in ft.fused_features(fitted.transform(texts, "text"), irony).collect()}
    assert list(rows["r1"][-2:]) == [1.0, 0.75] and list(rows["r2"][-2:]) == [0.0, 0.25]
    assert rows["r3"][-2] == 0.0 and math.isnan(rows["r3"][-1])


@pytest.fixture(scope="module")
def labelled(spark):
    """Separable but for every tenth row; two negatives to one positive."""
    words = F.when((F.col("id") % 3 == 0) != (F.col("id") % 10 == 9), "great lovely fine").otherwise("awful boring poor")
    filler = F.concat(F.lit(" word"), (F.col("id") % 7).cast("string"), F.lit(" plot"))
    df = spark.range(240).select(
        F.concat(F.lit("r"), "id").alias("review_id"),
        F.lit("m").alias("movie_id"),
        F.lit("t").alias("movie_title"),
        (F.col("id") % 3 == 0).cast("int").alias("polarity"),
        F.concat(words, filler).alias("preprocessed_text"),
        F.when(F.col("id") % 3 == 0, "ENTLBL_ORG ENTTXT_good").otherwise("ENTLBL_ORG ENTTXT_bad").alias("ner_text"),
    )
    df = df.withColumn("augmented_text", F.concat_ws(" [SEP] ", "preprocessed_text", "ner_text"))
    return stratified_split(df, ["polarity"], 0.25, seed=1).persist()


@pytest.fixture(scope="module")
def evaluation(labelled):
    return mo.evaluate_sources(labelled.filter("split = 'train'"), labelled.filter("split = 'test'"))


def test_weights_are_balanced(labelled):
    weighted, n = mo.with_balanced_weights(labelled, "polarity")
    sums = {r.polarity: r.s for r in weighted.groupBy("polarity").agg(F.sum("weight").alias("s")).collect()}
    assert n == 240 and sums == {0: pytest.approx(120), 1: pytest.approx(120)}


def test_every_model_beats_the_coin(evaluation):
    rows = {(r.text_source, r.model): r for r in evaluation.summary.collect()}
    assert len(rows) == 6
    for source in ("preprocessed_text", "augmented_text"):
        coin = rows[(source, mo.UNIFORM)]
        assert 0.2 < coin.accuracy < 0.8
        for name in (mo.LOGISTIC, mo.SVM):
            assert rows[(source, name)].weighted_f1 > max(0.8, coin.weighted_f1)
    assert all(r.classification_time_seconds > 0 for r in rows.values())


def test_best_labels_per_source(labelled, evaluation):
    test = labelled.filter("split = 'test'").select("review_id", "polarity")
    done = mo.best_predictions(test, evaluation.predictions, evaluation.summary, ["preprocessed_text", "augmented_text"])
    rows = done.collect()
    assert len(rows) == test.count()
    assert {r.preprocessed_text_prediction_model for r in rows} <= {mo.LOGISTIC, mo.SVM}
    assert {r.augmented_text_prediction_result for r in rows} == {"POSITIVE", "NEGATIVE"}


def test_corpus_scores(labelled, evaluation):
    rows = mo.score_corpus(labelled, evaluation.trained["preprocessed_text"]).collect()
    assert len(rows) == 3 * 240
    for r in rows:
        assert r.predicted_label == ("POSITIVE" if r.predicted else "NEGATIVE")
        assert 0.0 <= r.predicted_positive_probability <= 1.0
        if r.model == mo.LOGISTIC:
            assert (r.predicted_positive_probability > 0.5) == bool(r.predicted)
    by_model = {m: [r for r in rows if r.model == m] for m in mo.MODELS}
    margin_order = sorted(by_model[mo.SVM], key=lambda r: r.predicted_positive_probability)
    assert margin_order[0].predicted == 0 and margin_order[-1].predicted == 1


def test_scoring_plan_has_one_scan_and_no_python(labelled, evaluation, tmp_path, spark):
    labelled.write.parquet(str(tmp_path / "t"))
    stored = spark.read.parquet(str(tmp_path / "t"))
    plan = mo.score_corpus(stored, evaluation.trained["preprocessed_text"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan and "Exchange" not in plan


def length_scorer():
    return lambda batch: np.array([[1.0, 1.0 + len(t) / 4] if t else [2.0, 0.0] for t in batch])


def test_scoring_with_a_given_model(texts):
    rows = {r.review_id: r for r in mo.score_with(texts, length_scorer, "text").collect()}
    assert (rows["r1"].predicted_label, rows["r4"].predicted_label) == ("POSITIVE", "NEGATIVE")
    assert rows["r4"].predicted_positive_probability == pytest.approx(1 / (1 + math.exp(2)))


def irony_scorer():
    return lambda batch: [("irony" if len(t) > 512 else "non_irony", len(t) / 1000) for t in batch]


def test_irony_sees_whole_texts_and_skips_blank_ones(spark):
    df = spark.createDataFrame([("a", "x" * 600), ("b", " "), ("c", None), ("d", "y")], "review_id string, text string")
    rows = {r.review_id: (r.label, r.score) for r in mo.irony_scores(df, irony_scorer, "text").collect()}
    assert rows == {"a": ("irony", 0.6), "b": (None, None), "c": (None, None), "d": ("non_irony", 0.001)}


def test_uniform_labels_are_even_and_stable(spark):
    df = spark.range(2000).select(F.col("id").cast("string").alias("review_id"))
    rows = df.select(mo.uniform_label(F.col("review_id"), 99).alias("x")).agg(F.avg("x")).first()[0]
    assert 0.46 < rows < 0.54


def test_words_and_vectors_agree_with_counting_by_hand(spark):
    texts = [" ".join(f"w{(i * j) % 11}" for j in range(i % 8)) for i in range(40)] + [None, "", "w1 x w2"]
    df = spark.createDataFrame(list(enumerate(texts)), "review_id int, text string").coalesce(1)
    grams = []
    for text in texts:
        words = [w for w in (text or "").split() if len(w) > 1]
        grams.append(words + [f"{a} {b}" for a, b in zip(words, words[1:])])
    totals = {g: (sum(row.count(g) for row in grams), sum(g in row for row in grams)) for row in grams for g in row}
    built = ft.vocabulary(df, "text", 10_000, 1)
    assert {r["term"]: (r["count"], r["df"]) for r in built.collect()} == totals
    plan = ft._totals(df, "text", 1, True, None)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "lambda" not in plan  # a task shuffles distinct terms of many rows

    fitted = ft.Vectorizer(["w1", "w1 w2", "w3", "w3 w6", "zz w9"], [1.5, 2.0, 0.5, 3.0, 1.0])
    for row, vector in zip(grams, (r.features for r in fitted.transform(df, "text").orderBy("review_id").collect())):
        weights = {i: row.count(t) * w for i, (t, w) in enumerate(zip(fitted.terms, fitted.idf)) if t in row}
        norm = sum(w * w for w in weights.values()) ** 0.5
        assert vector.size == 5 and dict(zip(vector.indices.tolist(), vector.values.tolist())) == {
            i: pytest.approx(w / norm) for i, w in weights.items()
        }
