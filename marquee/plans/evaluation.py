"""From labels to compared models and a scored test set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.labels import polarity_number
from marquee.operators import metrics, models
from marquee.operators.sample import stratified_split


def split_evaluation_set(voted: DataFrame, fraction: float = 0.2, seed: int = 99) -> DataFrame:
    """Reviews with a binary voted label, split within each label."""
    numbered = voted.withColumn("polarity", polarity_number(F.col("ground_truth_polarity")))
    return stratified_split(numbered.filter(F.col("polarity").isin(0, 1)), ["polarity"], fraction, seed)


def best_trained(evaluation: models.Evaluation, source: str) -> tuple[models.Trained, str]:
    """The fitted models of a text source and the name of the best one."""
    # One row per text source.
    best = {r["text_source"]: r["model"] for r in metrics.best_model(evaluation.summary).collect()}
    return evaluation.trained[source], best[source]


def score_test_set(
    test: DataFrame,
    trained: models.Trained,
    model: str,
    label: str = "ground_truth",
    keep: Sequence[str] = ("review_id", "movie_id", "movie_title"),
) -> tuple[DataFrame, DataFrame]:
    """Predictions of one model for a test set, and their summary.

    Rows without a binary label are scored and counted, but left out of the
    metrics.
    """
    chosen = models.Trained(trained.source, trained.features, tuple(m for m in trained.models if m.name == model))
    numbered = test.withColumn("polarity", polarity_number(F.col(label)))
    predictions = models.score_corpus(numbered, chosen, (*keep, "polarity"))
    return predictions, metrics.labeled_report(predictions)
