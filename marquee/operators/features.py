"""TF-IDF over words and word pairs, and extra features beside it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.binding import let
from marquee.functions.counting import Coded, coded, runs, steps
from marquee.functions.labels import irony_flag

WORD = r"[\p{L}\p{N}_]{2,}"
VOCABULARY_SCHEMA = "term string, count bigint, df bigint"
# How many words the choice of pairs may look up.
FREQUENT_WORDS = 20_000


def words(text: Column) -> Column:
    """Lower-case words of two or more characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), 0)


def _pairs(w: Column) -> Column:
    """Each word with its right neighbour; a null on either side makes no pair."""
    n_pairs = F.greatest(F.size(w) - 1, F.lit(0))
    left, right = F.slice(w, F.lit(1), n_pairs), F.slice(w, F.lit(2), n_pairs)
    return F.filter(F.zip_with(left, right, lambda a, b: F.concat(a, F.lit(" "), b)), lambda p: p.isNotNull())


def term_array(terms: Sequence[str]) -> Column:
    """Terms as one array literal: one text, split again, as terms hold no line breaks."""
    return F.split(F.lit("\n".join(terms)), "\n")


def grams(text: Column) -> Column:
    """Words, then pairs of neighbouring words."""
    return let(words(text), lambda w: F.concat(w, _pairs(w)))


def _counted(codes: np.ndarray, rows: np.ndarray, terms: pa.Array) -> pa.RecordBatch:
    """(term, tf, df) of the codes that occur in a step."""
    run = runs(rows, codes)
    n = len(terms)
    tf, df = np.bincount(codes, minlength=n), np.bincount(codes[run.order[run.starts]], minlength=n)
    return pa.RecordBatch.from_arrays([terms, pa.array(tf, pa.int64()), pa.array(df, pa.int64())], names=["term", "tf", "df"])


def _counted_pairs(found: Coded, kept: np.ndarray) -> pa.RecordBatch:
    """The same of neighbouring words that are both ``kept`` (a flag for each code)."""
    left, right = found.codes[:-1], found.codes[1:]
    beside = (found.rows[1:] == found.rows[:-1]) & kept[left] & kept[right]
    left, right = left[beside].astype(np.int64), right[beside]
    n = max(1, len(found.words))
    pairs, codes = np.unique(left * n + right, return_inverse=True)
    words = [found.words.take(pa.array(side)) for side in (pairs // n, pairs % n)]
    return _counted(codes, found.rows[:-1][beside], pc.binary_join_element_wise(*words, " "))


def _totals(df: DataFrame, text: str, min_df: int, single: bool, pairs_of: Sequence[str] | None = ()) -> DataFrame:
    """(term, count, df) of the words, if ``single``, and of pairs whose words are in ``pairs_of`` (None: all).

    A task counts the words of a step together; what it shuffles are the step's distinct terms.
    """

    def work(batches):
        listed = None if pairs_of is None else pa.array(pairs_of, pa.string())
        for batch in batches:
            for step in steps(batch, ["w"]):
                found = coded(step.column("w"))
                if not len(found.codes):
                    continue
                if single:
                    yield _counted(found.codes, found.rows, found.words)
                if listed is None:
                    yield _counted_pairs(found, np.ones(len(found.words), dtype=bool))
                elif len(listed):
                    yield _counted_pairs(found, pc.is_in(found.words, listed).to_numpy(zero_copy_only=False))

    counted = df.select(words(F.col(text)).alias("w")).mapInArrow(work, "term string, tf bigint, df bigint")
    return counted.groupBy("term").agg(F.sum("tf").alias("count"), F.sum("df").alias("df")).filter(F.col("df") >= min_df)


def vocabulary(df: DataFrame, text: str, max_features: int = 5000, min_df: int = 2) -> DataFrame:
    """(term, count, df): the most frequent grams that enough rows hold.

    Ties of the total count go in term order.  A pair is never more frequent
    than either of its words.  So the words are counted first, and pairs only
    of words that are frequent enough to have one in the result: of the many
    distinct pairs of a large corpus few are ever shuffled.  Should too many
    words qualify, all pairs are counted.
    """
    order = [F.col("count").desc(), F.col("term")]
    text_only = df.select(text)
    best = _totals(text_only, text, min_df, single=True).orderBy(*order).limit(FREQUENT_WORDS).collect()
    least = best[max_features - 1]["count"] if len(best) >= max_features else 0
    if len(best) == FREQUENT_WORDS and best[-1]["count"] >= least:
        return _totals(text_only, text, min_df, single=True, pairs_of=None).orderBy(*order).limit(max_features)
    frequent = [r for r in best if r["count"] >= least]
    if not frequent:
        return df.sparkSession.createDataFrame([], VOCABULARY_SCHEMA)
    single = df.sparkSession.createDataFrame(frequent, VOCABULARY_SCHEMA)
    return single.unionByName(_totals(text_only, text, min_df, single=False, pairs_of=[r["term"] for r in frequent])).orderBy(*order).limit(max_features)


@dataclass(frozen=True)
class Vectorizer:
    """A fitted TF-IDF: ``tf * (ln((1 + n) / (1 + df)) + 1)``, length 1 per row."""

    terms: list[str]
    idf: list[float]

    def transform(self, df: DataFrame, text: str, out: str = "features") -> DataFrame:
        if not self.terms:
            raise ValueError("the vocabulary is empty: no term occurs in enough rows")
        counted = CountVectorizerModel.from_vocabulary(self.terms, inputCol="_grams", outputCol="_tf")
        weighed = ElementwiseProduct(scalingVec=Vectors.dense(self.idf), inputCol="_tf", outputCol="_w")
        unit = Normalizer(p=2.0, inputCol="_w", outputCol=out)
        return unit.transform(weighed.transform(counted.transform(df.withColumn("_grams", grams(F.col(text)))))).drop("_grams", "_tf", "_w")


def fit_vectorizer(df: DataFrame, text: str, max_features: int = 5000, min_df: int = 2) -> Vectorizer:
    """Choose the vocabulary and its weights; at most ``max_features`` rows reach the driver."""
    n = df.agg(F.count(F.lit(1))).scalar()
    weight = F.log((n + 1) / (F.col("df") + 1)) + 1
    rows = vocabulary(df, text, max_features, min_df).select("term", weight.alias("idf")).collect()
    chosen = sorted((r["term"], r["idf"]) for r in rows)
    return Vectorizer([t for t, _ in chosen], [w for _, w in chosen])


def long_form(df: DataFrame, vectorizer: Vectorizer, features: str = "features", keep: tuple[str, ...] = ("review_id",)) -> DataFrame:
    """(keep..., term, weight) of the non-zero entries of a feature column."""
    names = term_array(vectorizer.terms)
    vector = F.unwrap_udt(features)
    pairs = df.select(*keep, F.inline(F.arrays_zip(vector["indices"].alias("i"), vector["values"].alias("w"))))
    pairs = pairs.toDF(*keep, "i", "w")
    return pairs.select(*keep, F.element_at(names, F.col("i") + 1).alias("term"), F.col("w").alias("weight"))


def tfidf_terms(df: DataFrame, text: str, max_features: int = 5000, min_df: int = 2, keep: tuple[str, ...] = ("review_id",)) -> DataFrame:
    fitted = fit_vectorizer(df, text, max_features, min_df)
    return long_form(fitted.transform(df, text), fitted, keep=keep)


@dataclass(frozen=True)
class SourceFeatures:
    """The feature column of a text source.

    The augmented source has two vocabularies side by side: one over the text,
    one over the entity features.
    """

    parts: tuple[tuple[str, Vectorizer], ...]

    def transform(self, df: DataFrame, out: str = "features") -> DataFrame:
        if len(self.parts) == 1:
            column, vectorizer = self.parts[0]
            return vectorizer.transform(df, column, out)
        names = [f"_part{i}" for i in range(len(self.parts))]
        for name, (column, vectorizer) in zip(names, self.parts):
            df = vectorizer.transform(df, column, name)
        return VectorAssembler(inputCols=names, outputCol=out).transform(df).drop(*names)


def fit_source_features(
    train: DataFrame,
    source: str,
    text: str = "preprocessed_text",
    entity_text: str = "ner_text",
    text_terms: int = 5000,
    entity_terms: int = 1500,
) -> SourceFeatures:
    if source != "augmented_text":
        return SourceFeatures(((source, fit_vectorizer(train, source, text_terms)),))
    return SourceFeatures(
        (
            (text, fit_vectorizer(train, text, text_terms)),
            (entity_text, fit_vectorizer(train, entity_text, entity_terms)),
        )
    )


def add_irony(df: DataFrame, irony: DataFrame, doc_id: str = "review_id") -> DataFrame:
    """Adds ``irony_label`` (0 or 1) and ``irony_score``; a missing score stays null."""
    joined = df.join(irony.select(doc_id, "label", "score"), doc_id, "left")
    return joined.withColumns({"irony_label": irony_flag(F.col("label")), "irony_score": F.col("score")}).drop("label", "score")


def fused_features(df: DataFrame, irony: DataFrame, features: str = "features", out: str = "fused") -> DataFrame:
    """Text features, irony label and irony score in one vector (null score: NaN)."""
    assembler = VectorAssembler(
        inputCols=[features, "irony_label", "irony_score"], outputCol=out, handleInvalid="keep"
    )
    return assembler.transform(add_irony(df, irony))
