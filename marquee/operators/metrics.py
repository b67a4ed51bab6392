"""Scores of predictions and comparisons of models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.functions import labels as lb
from marquee.operators.groups import first_per_key

MODEL_KEYS = ("text_source", "model")


def _ratio(above: Column, below: Column) -> Column:
    return F.when(below == 0, 0.0).otherwise(above / below)


def _per_label(df: DataFrame, truth: str, predicted: str, keys: Sequence[str]) -> DataFrame:
    """precision, recall, f1 and support of every label that occurs on either side.

    Rows meet only in the confusion counts, a few rows per model.
    """
    confusion = df.groupBy(*keys, truth, predicted).agg(F.count(F.lit(1)).alias("_n"))
    sides = confusion.select(
        *keys,
        F.inline(
            F.array(
                F.struct(
                    F.col(truth).alias("label"),
                    F.col("_n").alias("_true"),
                    F.lit(0).cast("bigint").alias("_pred"),
                    F.when(F.col(truth) == F.col(predicted), F.col("_n")).otherwise(0).alias("_hit"),
                ),
                F.struct(
                    F.col(predicted).alias("label"),
                    F.lit(0).cast("bigint").alias("_true"),
                    F.col("_n").alias("_pred"),
                    F.lit(0).cast("bigint").alias("_hit"),
                ),
            )
        ),
    )
    sums = sides.groupBy(*keys, "label").agg(
        F.sum("_true").alias("_true"), F.sum("_pred").alias("_pred"), F.sum("_hit").alias("_hit")
    )
    hit, true, pred = F.col("_hit"), F.col("_true"), F.col("_pred")
    # Numbers 0 and 1 are shown as polarities, any other label as it is.
    text = F.col("label").cast("string")
    name = F.when(text == "1", lb.POSITIVE).when(text == "0", lb.NEGATIVE).otherwise(text)
    return sums.select(
        *keys,
        name.alias("label"),
        _ratio(hit, pred).alias("precision"),
        _ratio(hit, true).alias("recall"),
        _ratio(2.0 * hit, true + pred).alias("f1_score"),
        true.cast("double").alias("support"),
        hit.alias("_hit"),
    )


def class_report(
    df: DataFrame, truth: str = "truth", predicted: str = "predicted", keys: Sequence[str] = MODEL_KEYS
) -> DataFrame:
    """Per label, ``accuracy``, ``macro avg`` and ``weighted avg`` rows per model.

    The accuracy row repeats its value in every column.
    """
    labels = _per_label(df, truth, predicted, keys)
    score_names = ["precision", "recall", "f1_score"]
    total = F.sum("support")
    weighted = [(F.sum(F.col(c) * F.col("support")) / total).alias(f"w_{c}") for c in score_names]
    totals = labels.groupBy(*keys).agg(
        (F.sum("_hit") / total).alias("accuracy"),
        total.alias("support"),
        *[F.avg(c).alias(f"m_{c}") for c in score_names],
        *weighted,
    )

    def row(name: str, precision: str, recall: str, f1: str, support: str) -> Column:
        return F.struct(
            F.lit(name).alias("label"),
            F.col(precision).alias("precision"),
            F.col(recall).alias("recall"),
            F.col(f1).alias("f1_score"),
            F.col(support).alias("support"),
        )

    averages = totals.select(
        *keys,
        F.inline(
            F.array(
                row("accuracy", "accuracy", "accuracy", "accuracy", "accuracy"),
                row("macro avg", "m_precision", "m_recall", "m_f1_score", "support"),
                row("weighted avg", "w_precision", "w_recall", "w_f1_score", "support"),
            )
        ),
    )
    return labels.drop("_hit").unionByName(averages)


def model_summary(report: DataFrame, keys: Sequence[str] = MODEL_KEYS) -> DataFrame:
    """accuracy, macro F1 and weighted F1 of each model, from ``class_report`` rows."""

    def f1_of(label: str) -> Column:
        return F.max(F.when(F.col("label") == label, F.col("f1_score")))

    return report.groupBy(*keys).agg(
        f1_of("accuracy").alias("accuracy"),
        f1_of("macro avg").alias("macro_f1"),
        f1_of("weighted avg").alias("weighted_f1"),
    )


def prediction_balance(predictions: DataFrame, keys: Sequence[str] = ("model", "text_source")) -> DataFrame:
    """Rows, negative and positive counts and the positive share per model."""
    positive = F.count_if(F.col("predicted_label") == lb.POSITIVE)
    rows = F.count(F.lit(1))
    return predictions.groupBy(*keys).agg(
        rows.alias("rows_scored"),
        F.count_if(F.col("predicted_label") == lb.NEGATIVE).alias("predicted_negative"),
        positive.alias("predicted_positive"),
        F.when(rows > 0, positive / rows).alias("predicted_positive_share"),
    )


def labeled_report(
    predictions: DataFrame, truth: str = "polarity", predicted: str = "predicted", keys: Sequence[str] = MODEL_KEYS
) -> DataFrame:
    """Rows scored, and scores over those with a binary label; null when none."""
    scored = predictions.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_scored"))
    known = predictions.filter(F.col(truth).isin(0, 1))
    summary = model_summary(class_report(known, truth, predicted, keys), keys)
    return scored.join(summary, list(keys), "left")


def best_model(summary: DataFrame, source: str = "text_source") -> DataFrame:
    """The best model per text source: weighted F1, then accuracy, then name."""
    order = [F.col("weighted_f1").desc(), F.col("accuracy").desc(), F.col("model")]
    return first_per_key(summary, [source], order)


# The order in which text sources are listed.
SOURCE_ORDER = ["preprocessed_text", "ner_text", "hybrid_text", "augmented_text"]


def source_rank(source: Column) -> Column:
    """Known sources in their fixed order; all others share the place after them."""
    return reduce(
        lambda acc, item: acc.when(source == item[1], item[0]),
        list(enumerate(SOURCE_ORDER))[1:],
        F.when(source == SOURCE_ORDER[0], 0),
    ).otherwise(len(SOURCE_ORDER))


def compare_models(summary: DataFrame, report: DataFrame, timed_rows: int | Column) -> DataFrame:
    """One line per model with macro scores and throughput.

    ``rank`` is the place inside the text source, ``overall_best`` marks the
    one best line of all.  Throughput is infinite when no time was measured.
    """
    macro = report.filter(F.col("label") == "macro avg").select(
        *MODEL_KEYS,
        F.col("precision").alias("macro_precision"),
        F.col("recall").alias("macro_recall"),
        F.col("f1_score").alias("macro_f1_score"),
    )
    rows = timed_rows if isinstance(timed_rows, Column) else F.lit(timed_rows)
    seconds = F.col("classification_time_seconds")
    lines = summary.select(*MODEL_KEYS, "accuracy", "weighted_f1", "classification_time_seconds").join(
        macro, list(MODEL_KEYS), "left"
    )
    shown = lines.select(
        *MODEL_KEYS,
        F.round("accuracy", 3).alias("accuracy"),
        *[F.round(F.coalesce(c, F.lit(0.0)), 3).alias(c) for c in ("macro_precision", "macro_recall", "macro_f1_score")],
        F.round("weighted_f1", 3).alias("weighted_f1"),
        F.when(seconds > 0, F.round(rows / seconds, 2)).otherwise(F.lit(float("inf"))).alias("throughput"),
        F.col("weighted_f1").alias("_exact"),
    )
    # A summary holds one line per model and source: small by construction.
    order = [F.col("_exact").desc(), F.col("model")]
    inside = Window.partitionBy("text_source").orderBy(*order)
    overall = shown.agg(F.max(F.struct("_exact", "text_source", "model"))).scalar()
    best = F.struct("_exact", "text_source", "model") == overall
    return (
        shown.withColumn("rank", F.row_number().over(inside))
        .withColumn("overall_best", best)
        .orderBy(source_rank(F.col("text_source")), "text_source", "rank")
        .drop("_exact")
    )
