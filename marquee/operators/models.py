"""Polarity models on ``pyspark.ml``, and scoring with models the user brings."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.labels import polarity_label
from marquee.functions.ordering import draw_key
from marquee.operators import metrics
from marquee.operators.features import SourceFeatures, fit_source_features
from marquee.operators.sample import stratified_split
from marquee.session import materialise

LOGISTIC, SVM, UNIFORM = "logistic_regression", "linear_svm", "uniform_baseline"
MODELS = (LOGISTIC, SVM, UNIFORM)


# An optimiser step is one job over all partitions: a few thousand rows per
# task keep small training sets from paying for empty tasks.
ROWS_PER_TASK = 5_000


def with_balanced_weights(df: DataFrame, label: str, out: str = "weight") -> tuple[DataFrame, int]:
    """Adds ``n / (classes * n_class)`` and returns the row count too."""
    counts = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    weight = reduce(
        lambda acc, c: acc.when(F.col(label) == c, total / (len(counts) * counts[c])),
        list(counts)[1:],
        F.when(F.col(label) == next(iter(counts)), total / (len(counts) * next(iter(counts.values())))),
    )
    return df.coalesce(max(1, total // ROWS_PER_TASK)).withColumn(out, weight), total


@dataclass(frozen=True)
class Fitted:
    """A fitted model: adds ``<name>_label`` (0/1) and ``<name>_prob``."""

    name: str
    model: LogisticRegressionModel | LinearSVCModel | None = None
    calibrator: LogisticRegressionModel | None = None
    seed: int = 99

    def transform(self, df: DataFrame, doc_id: str = "review_id") -> DataFrame:
        label, prob = f"{self.name}_label", f"{self.name}_prob"
        if self.name == UNIFORM:
            return df.withColumn(label, uniform_label(F.col(doc_id), self.seed)).withColumn(prob, F.lit(0.5))
        scored = self.model.transform(df).withColumn(label, F.col("prediction").cast("int"))
        if self.calibrator is None:
            return scored.withColumn(prob, vector_to_array("probability")[1]).drop(
                "rawPrediction", "probability", "prediction"
            )
        margin = vector_to_array("rawPrediction")[1]
        slope, shift = float(self.calibrator.coefficients[0]), float(self.calibrator.intercept)
        return scored.withColumn(prob, 1 / (1 + F.exp(-(margin * slope + shift)))).drop("rawPrediction", "prediction")


def uniform_label(doc_id: Column, seed: int) -> Column:
    """A fair coin per id, the same on every run."""
    return F.when(F.substring(draw_key(seed, doc_id), 1, 1) < "8", 0).otherwise(1)


def fit_logistic(train: DataFrame, label: str = "polarity", features: str = "features") -> Fitted:
    """Balanced, L2-regularised; strength and tolerance as in a summed loss with C = 1."""
    weighted, n = with_balanced_weights(train, label)
    fit = LogisticRegression(
        featuresCol=features, labelCol=label, weightCol="weight", maxIter=200, tol=1e-4, regParam=1.0 / n, standardization=False
    ).fit(weighted)
    return Fitted(LOGISTIC, fit)


def _fit_margin(train: DataFrame, label: str, features: str) -> LinearSVCModel:
    weighted, n = with_balanced_weights(train, label)
    return LinearSVC(
        featuresCol=features, labelCol=label, weightCol="weight", maxIter=100, tol=1e-3, regParam=1.0 / n, standardization=False
    ).fit(weighted)


def fit_svm(
    train: DataFrame, label: str = "polarity", features: str = "features", doc_id: str = "review_id", seed: int = 99
) -> Fitted:
    """Balanced linear SVM with a probability.

    Platt's sigmoid is fitted on the margins of rows a first fit has not seen,
    with his soft targets: a row counts for both classes, by its target.
    """
    model = _fit_margin(train, label, features)
    parts = stratified_split(train, [label], 0.2, seed, doc_id)
    held_out = _fit_margin(parts.filter("split = 'train'"), label, features).transform(parts.filter("split = 'test'"))
    margins = materialise(
        held_out.select(F.col(label).alias("y"), vector_to_array("rawPrediction")[1].alias("margin")), "margins"
    )
    counts = {r["y"]: r["n"] for r in margins.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    soft = F.when(F.col("y") == 1, (counts.get(1, 0) + 1) / (counts.get(1, 0) + 2)).otherwise(
        1 / (counts.get(0, 0) + 2)
    )
    doubled = margins.select(
        "margin",
        F.inline(
            F.array(
                F.struct(F.lit(1.0).alias("target"), soft.alias("w")),
                F.struct(F.lit(0.0).alias("target"), (1 - soft).alias("w")),
            )
        ),
    )
    sigmoid = LogisticRegression(
        featuresCol="m", labelCol="target", weightCol="w", maxIter=100, regParam=0.0, standardization=False
    ).fit(VectorAssembler(inputCols=["margin"], outputCol="m").transform(doubled.coalesce(max(1, sum(counts.values()) // ROWS_PER_TASK))))
    return Fitted(SVM, model, sigmoid, seed)


def fit_model(name: str, train: DataFrame, label: str = "polarity", seed: int = 99) -> Fitted:
    if name == LOGISTIC:
        return fit_logistic(train, label)
    if name == SVM:
        return fit_svm(train, label, seed=seed)
    if name == UNIFORM:
        return Fitted(UNIFORM, seed=seed)
    raise ValueError(f"unknown model: {name}")


@dataclass(frozen=True)
class Trained:
    """All models of one text source and the features they were fitted on."""

    source: str
    features: SourceFeatures
    models: tuple[Fitted, ...]


def train_source(
    train: DataFrame, source: str, names: Sequence[str] = MODELS, label: str = "polarity", seed: int = 99
) -> Trained:
    """Features once, then every model on the same stored feature table."""
    features = fit_source_features(train, source)
    stored = materialise(features.transform(train).select("review_id", label, "features"), "train-features")
    return Trained(source, features, tuple(fit_model(n, stored, label, seed) for n in names))


def score_corpus(
    df: DataFrame, trained: Trained, keep: Sequence[str] = ("review_id", "movie_id", "movie_title")
) -> DataFrame:
    """Every model's label and probability for every row, long form, in one scan."""
    scored = trained.features.transform(df)
    for model in trained.models:
        scored = model.transform(scored)
    per_model = F.array(
        *[
            F.struct(
                F.lit(m.name).alias("model"),
                F.lit(trained.source).alias("text_source"),
                F.col(f"{m.name}_label").alias("predicted"),
                polarity_label(F.col(f"{m.name}_label")).alias("predicted_label"),
                F.col(f"{m.name}_prob").alias("predicted_positive_probability"),
            )
            for m in trained.models
        ]
    )
    return scored.select(*keep, F.inline(per_model))


@dataclass(frozen=True)
class Evaluation:
    report: DataFrame
    summary: DataFrame
    predictions: DataFrame
    trained: dict[str, Trained]


def evaluate_sources(
    train: DataFrame,
    test: DataFrame,
    sources: Sequence[str] = ("preprocessed_text", "augmented_text"),
    names: Sequence[str] = MODELS,
    label: str = "polarity",
    seed: int = 99,
) -> Evaluation:
    """Fit every model on every text source and score the test rows.

    ``classification_time_seconds`` is the time of the job that scores the
    test rows of one source with one model, features included.
    """
    spark = train.sparkSession
    trained, predictions, times = {}, [], []
    for source in sources:
        fitted = train_source(train, source, names, label, seed)
        trained[source] = fitted
        for model in fitted.models:
            begin = time.perf_counter()
            one = Trained(source, fitted.features, (model,))
            stored = materialise(score_corpus(test, one, keep=("review_id", label)), "predictions")
            times.append((source, model.name, time.perf_counter() - begin))
            predictions.append(stored)
    everything = reduce(DataFrame.unionByName, predictions)
    report = metrics.class_report(everything, label, "predicted")
    # One row per source and model.
    timing = spark.createDataFrame(times, "text_source string, model string, classification_time_seconds double")
    summary = metrics.model_summary(report).join(F.broadcast(timing), ["text_source", "model"])
    return Evaluation(report, summary, everything, trained)


def best_predictions(test: DataFrame, predictions: DataFrame, summary: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Test rows with the best model of each text source and its label."""
    best = metrics.best_model(summary).select("text_source", "model")
    chosen = predictions.join(F.broadcast(best), ["text_source", "model"], "left_semi")
    wide = chosen.groupBy("review_id").agg(
        *[
            F.max(F.when(F.col("text_source") == s, F.col(c))).alias(f"{s}_prediction_{n}")
            for s in sources
            for c, n in (("model", "model"), ("predicted_label", "result"))
        ]
    )
    return test.join(wide, "review_id", "left")


# --- models the user brings ---------------------------------------------------


def score_with(
    df: DataFrame, make_scorer: Callable[[], Callable[[list[str]], np.ndarray]], text: str
) -> DataFrame:
    """Label and positive probability from a model that gives two logits per text.

    ``make_scorer`` runs once per Python worker; the scorer it returns gets
    Arrow batches of whole texts.
    """

    @F.pandas_udf("predicted int, predicted_positive_probability double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for texts in batches:
            logits = np.asarray(scorer(texts.fillna("").tolist()), dtype=float).reshape(len(texts), 2)
            odds = np.exp(logits - logits.max(axis=1, keepdims=True))
            yield pd.DataFrame(
                {
                    "predicted": logits.argmax(axis=1).astype("int32"),
                    "predicted_positive_probability": odds[:, 1] / odds.sum(axis=1),
                }
            )

    return (
        df.withColumn("_scored", run(F.col(text)))
        .select(*df.columns, "_scored.*")
        .withColumn("predicted_label", polarity_label(F.col("predicted")))
    )


def irony_scores(
    df: DataFrame,
    make_scorer: Callable[[], Callable[[list[str]], list[tuple[str, float]]]],
    text: str,
) -> DataFrame:
    """``label`` and ``score`` of a text classifier, which gets whole texts; blank text gives nulls."""

    @F.pandas_udf("label string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = make_scorer()
        for texts in batches:
            out = pd.DataFrame({"label": [None] * len(texts), "score": [None] * len(texts)}, dtype=object)
            filled = [i for i, t in enumerate(texts) if t is not None and t.strip()]
            if filled:
                for i, (label, score) in zip(filled, scorer([texts.iloc[i] for i in filled])):
                    out.at[i, "label"], out.at[i, "score"] = label, float(score)
            yield out.astype({"score": "float64"})

    return df.withColumn("_irony", run(F.col(text))).select(*df.columns, "_irony.*")
