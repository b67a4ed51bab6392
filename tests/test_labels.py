import pytest
from pyspark.sql import functions as F

from marquee.functions import labels as lb
from marquee.operators import annotators as an
from marquee.operators import metrics as me


def table(spark, rows, extra="notes"):
    names = f"review_id string, movie_id string, summary string, subjective_label string, polarity_label string, {extra} string"
    return spark.createDataFrame([(i, "m", "s" + i, s, p, "n") for i, s, p in rows], names)


def three(spark):
    return {
        "a": table(spark, [("1", "subjective", "positive"), ("2", "Objective", "positive"), ("3", None, None)]),
        "b": table(spark, [("1", "Subjective ", " NEGATIVE"), ("2", "subjective", "positive"), ("3", "x", "nan")], "NOTES"),
        "c": table(spark, [("1", "objective", "negative"), ("3", "subjective", "None"), ("4", "subjective", "positive")]),
    }


def test_merge_and_normalize(spark):
    merged = an.merge_annotators(three(spark))
    assert merged.columns[:3] == ["review_id", "movie_id", "summary"]
    assert not [c for c in merged.columns if "notes" in c.lower()]
    rows = {r.review_id: r for r in an.normalize_labels(merged).collect()}
    assert set(rows) == {"1", "3"}
    one = rows["1"]
    assert (one.polarity_label_a, one.polarity_label_b, one.polarity_label_c) == ("POSITIVE", "NEGATIVE", "NEUTRAL")
    assert one.subjective_label_c == "NEUTRAL"
    assert (rows["3"].polarity_label_b, rows["3"].subjective_label_b) == (None, None)


def test_no_common_key_raises(spark):
    tables = three(spark)
    tables["b"] = tables["b"].drop("review_id", "movie_id")
    with pytest.raises(ValueError, match="share no key"):
        an.merge_annotators(tables)


def votes(spark, *rows):
    return spark.createDataFrame(list(rows), "a string, b string, c string")


P, N = "POSITIVE", "NEGATIVE"


def test_kappa_by_hand(spark):
    # Four items, three raters: agreement 1, 1, 1/3, 1/3; shares 7/12 and 5/12.
    df = votes(spark, (P, P, P), (N, N, N), (P, P, N), (P, N, P), (P, None, P), (P, "NEUTRAL", P))
    row = an.fleiss_kappa(df, ["a", "b", "c"], [P, N]).first()
    expected = (7 / 12) ** 2 + (5 / 12) ** 2
    assert row.rows_used == 4
    assert row.observed_agreement == pytest.approx(2 / 3)
    assert row.fleiss_kappa == pytest.approx((2 / 3 - expected) / (1 - expected))
    assert row.status == "BELOW 0.80"


def test_kappa_without_rows_or_without_variety(spark):
    with pytest.raises(Exception, match="no complete rows"):
        an.fleiss_kappa(votes(spark, (P, None, P)), ["a", "b", "c"], [P, N]).collect()
    row = an.fleiss_kappa(votes(spark, (P, P, P)), ["a", "b", "c"], [P, N]).first()
    assert (row.fleiss_kappa, row.status) == (None, "UNDEFINED")
    row = an.fleiss_kappa(votes(spark, (P, P, P), (N, N, N)), ["a", "b", "c"], [P, N]).first()
    assert (row.fleiss_kappa, row.status) == (pytest.approx(1.0), "PASS")


@pytest.mark.parametrize(
    "given, label",
    [((P, N, N), N), ((P, N, "NEUTRAL"), P), ((None, N, P), N), ((None, None, P), P), ((None, None, None), None)],
)
def test_majority(spark, given, label):
    assert votes(spark, given).select(an.majority_label(["a", "b", "c"])).first()[0] == label


def test_distribution_counts_nulls(spark):
    df = votes(spark, (P, N, None), (P, P, None))
    rows = {r.label: (r.a, r.b, r.c) for r in an.label_distribution(df, ["a", "b", "c"]).collect()}
    assert rows == {P: (2, 1, 0), N: (0, 1, 0), None: (0, 0, 2)}


def test_polarity_numbers(spark):
    df = spark.createDataFrame([(" positive ",), ("NEG",), ("nan",), (None,), ("Neutral",)], "x string")
    assert [r[0] for r in df.select(lb.polarity_number(F.col("x"))).collect()] == [1, None, None, None, 2]


def outcomes(spark, counts, model="m"):
    rows = [(truth, predicted, "t", model) for (truth, predicted), n in counts.items() for _ in range(n)]
    return spark.createDataFrame(rows, "truth int, predicted int, text_source string, model string")


def test_report_known_answer(spark):
    # 114 negatives with 98 found, 86 positives with 71 found.
    df = outcomes(spark, {(0, 0): 98, (0, 1): 16, (1, 1): 71, (1, 0): 15})
    rows = {r.label: r for r in me.class_report(df).collect()}
    assert rows["NEGATIVE"].precision == pytest.approx(0.8672566371681416)
    assert rows["POSITIVE"].f1_score == pytest.approx(0.8208092485549133)
    assert {rows["accuracy"][c] for c in ("precision", "recall", "f1_score", "support")} == {0.845}
    assert rows["macro avg"].f1_score == pytest.approx(0.8421226859514654)
    assert rows["weighted avg"].f1_score == pytest.approx(0.8451065671869828)
    assert rows["weighted avg"].support == 200


def test_report_divides_by_zero_to_zero(spark):
    rows = {r.label: r for r in me.class_report(outcomes(spark, {(0, 1): 3})).collect()}
    assert (rows["NEGATIVE"].precision, rows["POSITIVE"].recall, rows["accuracy"].f1_score) == (0.0, 0.0, 0.0)


def test_labeled_report_is_null_without_labels(spark):
    df = spark.createDataFrame(
        [(None, 1, "t", "m"), (2, 0, "t", "m")], "polarity int, predicted int, text_source string, model string"
    )
    row = me.labeled_report(df).first()
    assert (row.rows_scored, row.accuracy, row.macro_f1) == (2, None, None)


def test_best_model_and_comparison(spark):
    names = "text_source string, model string, accuracy double, macro_f1 double, weighted_f1 double, classification_time_seconds double"
    summary = spark.createDataFrame(
        [
            ("augmented_text", "x", 0.8, 0.8, 0.81239, 0.0),
            ("preprocessed_text", "x", 0.7, 0.7, 0.7, 2.0),
            ("preprocessed_text", "y", 0.9, 0.7, 0.7, 4.0),
            ("other", "x", 0.1, 0.1, 0.1, 1.0),
        ],
        names,
    )
    assert {r.text_source: r.model for r in me.best_model(summary).collect()} == {
        "augmented_text": "x", "preprocessed_text": "y", "other": "x",
    }
    report = spark.createDataFrame(
        [("preprocessed_text", "x", "macro avg", 0.12345, 0.2, 0.3, 9.0)],
        "text_source string, model string, label string, precision double, recall double, f1_score double, support double",
    )
    lines = me.compare_models(summary, report, 100).collect()
    assert [(r.text_source, r.model) for r in lines] == [
        ("preprocessed_text", "x"), ("preprocessed_text", "y"), ("augmented_text", "x"), ("other", "x"),
    ]
    assert (lines[0].macro_precision, lines[1].macro_precision, lines[0].throughput) == (0.123, 0.0, 50.0)
    assert lines[2].throughput == float("inf") and lines[2].overall_best and not lines[0].overall_best
