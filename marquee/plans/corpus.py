"""Whole-corpus jobs: preprocessing for one title, indexing, label feedback."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.functions.analysis import PLAIN, Analyzer
from marquee.operators.clean import to_index_docs
from marquee.operators.models import Trained, score_corpus
from marquee.operators.postings import SearchIndex, load_index, write_index
from marquee.operators.rows import attach_sentiment
from marquee.operators.titles import filter_sentences
from marquee.operators.tokens import preprocess


def preprocess_for_title(
    df: DataFrame,
    keys: DataFrame,
    dictionary: DataFrame,
    lemmas: DataFrame,
    stopwords: DataFrame,
    works: DataFrame | None = None,
) -> DataFrame:
    """``preprocess`` over the sentences that concern the review's own title.

    Sentences go first: cleaning would take away the marks that end them.
    """
    return preprocess(filter_sentences(df, keys, works=works), dictionary, lemmas, stopwords)


def index_reviews(
    reviews: DataFrame, path: str, analyzer: Analyzer = PLAIN, mode: str = "errorifexists", buckets: int | None = None
) -> SearchIndex:
    """Review rows to a written index."""
    write_index(to_index_docs(reviews), path, analyzer, mode, buckets)
    return load_index(reviews.sparkSession, path, analyzer)


def label_index_docs(docs: DataFrame, corpus: DataFrame, trained: Trained, model: str) -> DataFrame:
    """Score the corpus and put one model's labels into ``sentiment``."""
    return attach_sentiment(docs, score_corpus(corpus, trained), model)
