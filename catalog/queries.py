"""The registered queries: every operator over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as v
from marquee import session
from marquee.functions import labels as lb
from marquee.functions import text as tx
from marquee.functions.analysis import PLAIN
from marquee.operators import annotators as an
from marquee.operators import clean, entities, facets, features, metrics, models, postings, rows, sample, stats, titles
from marquee.operators import search as se
from marquee.operators import tokens as tk
from marquee.plans import corpus as plans
from marquee.schema import REVIEW_COLUMNS
from marquee.sources import flatten_review_pages, page_status, upsert_reviews

Query = Callable[[SparkSession, str], DataFrame]

# What the search queries ask for.
TERM, TERMS, PHRASE, WORD_IN_TITLE = "worthless", "pathetic worthless thing", "of the", "red plate"
CONTENT = ("content",)
HIT = ["id", "movie_title", "helpfulness_score", "score"]
WINDOWS = {
    "unfiltered": None,
    "years_1995_1996": ("1995-01-01 00:00:00", "1996-12-31 23:59:59"),
    "years_1997_1999": ("1997-01-01 00:00:00", "1999-12-31 23:59:59"),
}


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def _doc_row(df: DataFrame) -> DataFrame:
    """Index documents in types that every engine shows alike."""
    shown = _rounded(df, "helpfulness_score")
    return shown.withColumn("submission_date", F.date_format("submission_date", "yyyy-MM-dd HH:mm:ss"))


# --- sources ------------------------------------------------------------------


def flatten_pages(spark, d):
    return flatten_review_pages(v.response_pages(spark, d), v.movies(spark, d))


def status_of_pages(spark, d):
    return page_status(v.response_pages(spark, d))


def upsert(spark, d):
    current = v.docs(spark, d)
    changed = current.filter(F.substring("id", -1, 1) == "0").withColumns(
        {"upvotes": F.col("upvotes") + 100, "summary": F.lit("second")}
    )
    newer = current.filter(F.substring("id", -2, 2) == "00").withColumns(
        {"upvotes": F.col("upvotes") + 200, "summary": F.lit("third")}
    )
    added = current.filter(F.substring("id", -1, 1) == "7").withColumn("id", F.concat("id", F.lit("n")))
    return _doc_row(upsert_reviews(current, changed, newer.unionByName(added)))


# --- projections ----------------------------------------------------------------


def clean_reviews(spark, d):
    return clean.clean_reviews(v.raw_reviews(spark, d), order_by=["copy_no"]).select(*REVIEW_COLUMNS)


def valid_ratings(spark, d):
    return clean.valid_ratings(v.raw_reviews(spark, d), order_by=["copy_no"]).select(*REVIEW_COLUMNS)


def index_docs(spark, d):
    return _doc_row(clean.to_index_docs(v.raw_reviews(spark, d)))


def combine_text(spark, d):
    raw = v.raw_reviews(spark, d)
    return raw.select("review_id", "copy_no", tx.combine_text(F.col("summary"), F.col("content")).alias("text"))


def basic_clean(spark, d):
    return v.combined(spark, d).select("review_id", tx.basic_clean(F.col("text")).alias("text"))


def expand_slang(spark, d):
    lowered = v.combined(spark, d).select("review_id", F.lower("text").alias("text"))
    return tk.expand_slang(lowered, v.slang(spark))


def deep_clean(spark, d):
    return v.combined(spark, d).select("review_id", tx.deep_clean(F.col("text")).alias("text"))


def lemma_stop(spark, d):
    lowered = v.combined(spark, d).select("review_id", F.lower("text").alias("text"))
    found = tk.lemmatize_filter(lowered, v.lemmas(spark), v.stop_words(spark))
    return found.select("review_id", F.array_join("tokens", " ").alias("tokens"))


def _preprocessed(spark, d) -> DataFrame:
    r = v.combined(spark, d).select("review_id", "movie_id", "movie_title", "doc_id", "text")
    return tk.preprocess(r, v.slang(spark), v.lemmas(spark), v.stop_words(spark))


def preprocess(spark, d):
    return _preprocessed(spark, d).select("review_id", "processed_text")


def find_titles(spark, d):
    keys = titles.title_keys(v.movies(spark, d), v.aliases(spark))
    found = titles.find_titles(v.title_mentions(spark, d), keys)
    return found.select("review_id", F.array_join("titles", "|").alias("titles"))


def filter_sentences(spark, d):
    keys = titles.title_keys(v.movies(spark, d), v.aliases(spark))
    return titles.filter_sentences(v.title_mentions(spark, d), keys).select("review_id", "text")


def preprocess_for_title(spark, d):
    keys = titles.title_keys(v.movies(spark, d), v.aliases(spark))
    done = plans.preprocess_for_title(
        v.title_mentions(spark, d), keys, v.slang(spark), v.lemmas(spark), v.stop_words(spark)
    )
    return done.select("review_id", "processed_text")


def entity_features(spark, d):
    return entities.entity_features(v.entities(spark, d))


def augment_text(spark, d):
    base = v.reviews(spark, d).select("review_id", F.col("content").alias("preprocessed_text"))
    joined = entities.augment_text(base, entities.entity_features(v.entities(spark, d)))
    return joined.select("review_id", "augmented_text")


# --- labels -----------------------------------------------------------------------


def merge_annotators(spark, d):
    return an.merge_annotators(v.annotators(spark, d))


def _normalized(spark, d) -> DataFrame:
    return an.normalize_labels(an.merge_annotators(v.annotators(spark, d)))


def normalize_labels(spark, d):
    return _normalized(spark, d).drop("summary", "content")


def label_distribution(spark, d):
    df = _normalized(spark, d)
    kinds = []
    for kind in ("polarity", "subjective"):
        columns = an.label_columns(df, kind)
        counted = an.label_distribution(df, columns).withColumnsRenamed({c: c.split("_")[-1] for c in columns})
        kinds.append(counted.withColumn("kind", F.lit(kind)))
    return v.stack(kinds)


def fleiss_kappa(spark, d):
    df = _normalized(spark, d)
    asked = {"polarity": ["POSITIVE", "NEGATIVE"], "subjective": ["SUBJECTIVE", "NEUTRAL"]}
    found = []
    for kind, categories in asked.items():
        one = an.fleiss_kappa(df, an.label_columns(df, kind), categories)
        renamed = one.withColumnsRenamed({f"share_{c.lower()}": f"share_{i}" for i, c in enumerate(categories)})
        found.append(renamed.withColumn("kind", F.lit(kind)))
    numbers = ["share_0", "share_1", "observed_agreement", "expected_agreement", "fleiss_kappa"]
    return _rounded(v.stack(found), *numbers)


def majority_vote(spark, d):
    return an.majority_vote(_normalized(spark, d))


# --- joins ------------------------------------------------------------------------


def attach_text(spark, d):
    texts = v.reviews(spark, d).select("review_id", "content")
    return rows.attach_text(v.truth(spark, d).select("review_id", "polarity"), texts, "content")


def unlabeled(spark, d):
    return rows.without(v.reviews(spark, d), v.truth(spark, d)).select("review_id", "movie_id", "author_rating")


def overlap_count(spark, d):
    return rows.overlap_count(v.reviews(spark, d), v.truth(spark, d))


def attach_sentiment(spark, d):
    one_source = v.predictions(spark, d).filter(F.col("text_source") == "preprocessed_text")
    return rows.attach_sentiment(v.docs(spark, d), one_source, "model_a").select("id", "movie_id", "sentiment")


# --- counts -----------------------------------------------------------------------


def movie_counts(spark, d):
    return stats.movie_counts(v.raw_reviews(spark, d), v.all_titles(spark, d))


def value_counts(spark, d):
    return _rounded(stats.value_counts(v.raw_reviews(spark, d), "author_rating"), "share")


def corpus_stats(spark, d):
    return stats.corpus_stats(v.raw_reviews(spark, d))


def top_words(spark, d):
    return stats.top_words(_preprocessed(spark, d))


# --- samples ----------------------------------------------------------------------


def label_sample(spark, d):
    return sample.label_sample(clean.valid_ratings(v.reviews(spark, d).drop("doc_id")), total=400)


def equal_rating_sample(spark, d):
    return sample.equal_rating_sample(v.reviews(spark, d), v.truth(spark, d), total=50)


def stratified_split(spark, d):
    split = sample.stratified_split(v.reviews(spark, d), ["movie_title", "author_rating"], 0.2)
    return split.select("review_id", "movie_title", "author_rating", "split")


# --- metrics ----------------------------------------------------------------------


def class_report(spark, d):
    report = metrics.class_report(v.predictions(spark, d), "polarity", "predicted")
    return _rounded(report, "precision", "recall", "f1_score", "support")


def _summary(spark, d) -> DataFrame:
    return metrics.model_summary(metrics.class_report(v.predictions(spark, d), "polarity", "predicted"))


def model_summary(spark, d):
    return _rounded(_summary(spark, d), "accuracy", "macro_f1", "weighted_f1")


def best_model(spark, d):
    return _rounded(metrics.best_model(_summary(spark, d)), "accuracy", "macro_f1", "weighted_f1")


def best_predictions(spark, d):
    sources = ["preprocessed_text", "augmented_text"]
    test = v.truth(spark, d).select("review_id", "polarity")
    return models.best_predictions(test, v.predictions(spark, d), _summary(spark, d), sources)


def labeled_report(spark, d):
    # Predictions for every review; only some reviews carry a label.
    scored = (
        v.reviews(spark, d)
        .select("review_id", "doc_id")
        .withColumns(
            {
                "predicted": models.uniform_label(F.col("review_id"), 99),
                "text_source": F.lit("preprocessed_text"),
                "model": F.lit(models.UNIFORM),
            }
        )
        .join(v.truth(spark, d).select("review_id", "polarity"), "review_id", "left")
    )
    return _rounded(metrics.labeled_report(scored), "accuracy", "macro_f1", "weighted_f1")


def prediction_balance(spark, d):
    return _rounded(metrics.prediction_balance(v.predictions(spark, d)), "predicted_positive_share")


def compare_models(spark, d):
    report = metrics.class_report(v.predictions(spark, d), "polarity", "predicted")
    timed = v.timed_summary(spark, metrics.model_summary(report))
    n = v.truth(spark, d).agg(F.count(F.lit(1))).scalar()
    return metrics.compare_models(timed, report, n)


# --- search -----------------------------------------------------------------------


def _hits(spark, d, request: se.SearchRequest) -> DataFrame:
    return _rounded(se.search(v.docs(spark, d), request).select(*HIT), "helpfulness_score")


def search_bm25(spark, d):
    return _hits(spark, d, se.SearchRequest(TERM, CONTENT))


def search_terms_or(spark, d):
    return _hits(spark, d, se.SearchRequest(TERMS, CONTENT, k=20))


def search_phrase(spark, d):
    return _hits(spark, d, se.SearchRequest(PHRASE, CONTENT, phrase=True))


# The years reach further than the instants: both bounds have to hold.
FILTERED = se.SearchRequest(
    "thing of",
    CONTENT,
    title="red plate",
    min_rating=1,
    max_rating=4,
    start_year=1990,
    end_year=2000,
    start="1995-01-01 00:00:00",
    end="2001-12-31 00:00:00",
)


def search_filtered(spark, d):
    return _hits(spark, d, FILTERED)


REVIEW_REQUEST = se.SearchRequest(
    "plate of pathetic", movie="plate red", min_rating=3, start_year=1996, end_year=2000, k=10
)


def search_reviews(spark, d):
    return _rounded(se.search(v.docs(spark, d), REVIEW_REQUEST), "helpfulness_score")


def search_by_helpfulness(spark, d):
    return _hits(spark, d, se.SearchRequest(TERM, CONTENT, sort="helpfulness_score"))


def search_by_rating(spark, d):
    return _hits(spark, d, se.SearchRequest(TERM, CONTENT, sort="author_rating"))


def search_by_date(spark, d):
    return _hits(spark, d, se.SearchRequest(TERM, CONTENT, sort="submission_date"))


def search_boosted(spark, d):
    return _hits(spark, d, se.SearchRequest(TERM, CONTENT, boost="helpfulness_score"))


def _index(spark, d) -> postings.SearchIndex:
    docs = v.docs(spark, d)
    built = postings.build_postings(docs)
    return postings.SearchIndex(docs, built, postings.field_stats(built), PLAIN)


def _asked(spark, d, ask: Callable[[postings.SearchIndex], DataFrame]) -> DataFrame:
    """What ``ask`` finds in an index written for it.  The index, larger than its documents, goes with the answer."""
    path = session.scratch_folder(spark, "index")
    try:
        postings.write_index(v.docs(spark, d), path)
        found = ask(postings.load_index(spark, path))
        rows = found.collect()  # k hits, the first values of each facet, or a row a window
    finally:
        session.release_paths(spark, [path])
    return spark.createDataFrame(rows, found.schema)


def _index_hits(spark, d, request: se.SearchRequest) -> DataFrame:
    return _asked(spark, d, lambda index: _rounded(se.search_index(index, request).select(*HIT), "helpfulness_score"))


def index_bm25(spark, d):
    return _index_hits(spark, d, se.SearchRequest(TERM, CONTENT))


def index_phrase(spark, d):
    return _index_hits(spark, d, se.SearchRequest(PHRASE, CONTENT, phrase=True))


def index_filtered(spark, d):
    return _index_hits(spark, d, FILTERED)


def index_facets(spark, d):
    def ask(index):
        found = se.matching_index(index, se.SearchRequest(TERM, CONTENT, phrase=True))
        return facets.facet_many(found, ["movie_title", "year", "sentiment"], limit=10)

    return _asked(spark, d, ask)


def index_windows(spark, d):
    return _asked(spark, d, lambda index: se.count_windows(se.matching_index(index, se.SearchRequest(TERM, CONTENT)), WINDOWS))


def search_postings(spark, d):
    return _rounded(se.search_index(_index(spark, d), REVIEW_REQUEST), "helpfulness_score")


def search_postings_phrase(spark, d):
    request = se.SearchRequest(PHRASE, CONTENT, phrase=True)
    return _rounded(se.search_index(_index(spark, d), request).select(*HIT), "helpfulness_score")


def build_postings(spark, d):
    built = postings.build_postings(v.docs(spark, d))
    places = F.array_join(F.transform("positions", lambda p: p.cast("string")), " ")
    return built.drop("lead").withColumn("positions", places)


def term_stats(spark, d):
    built = postings.build_postings(v.docs(spark, d))
    return built.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))


def title_exact_vs_terms(spark, d):
    return se.exact_and_analysed_title(v.docs(spark, d), WORD_IN_TITLE)


def helpfulness_compare(spark, d):
    return se.compare_rankings(v.docs(spark, d), se.SearchRequest(TERM, CONTENT))


def date_windows(spark, d):
    return se.count_windows(se.matching(v.docs(spark, d), se.SearchRequest(TERM, CONTENT)), WINDOWS)


def _found(spark, d) -> DataFrame:
    return se.matching(v.docs(spark, d), se.SearchRequest(TERM, CONTENT, phrase=True))


def facet_movie(spark, d):
    return facets.facet_field(_found(spark, d), "movie_title", limit=20)


def facet_movie_all(spark, d):
    return facets.facet_field(_found(spark, d), "movie_title", limit=1000, mincount=0, corpus=v.docs(spark, d))


def facet_year(spark, d):
    return facets.facet_field(_found(spark, d), "year", limit=50)


def facet_rating(spark, d):
    return facets.facet_range(_found(spark, d), "author_rating", 1, 10, 3)


def facet_sentiment(spark, d):
    one_source = v.predictions(spark, d).filter(F.col("text_source") == "preprocessed_text")
    filled = rows.attach_sentiment(v.docs(spark, d), one_source, "model_a")
    return facets.facet_field(se.matching(filled, se.SearchRequest(TERM, CONTENT, phrase=True)), "sentiment")


def facet_multi(spark, d):
    return facets.facet_many(_found(spark, d), ["movie_title", "year", "sentiment"], limit=10)


# --- features and models ----------------------------------------------------------


def tfidf_terms(spark, d):
    r = v.reviews(spark, d).select("review_id", "content")
    return _rounded(features.tfidf_terms(r, "content"), "weight")


def fused_features(spark, d):
    r = v.reviews(spark, d).select("review_id", "content")
    fitted = features.fit_vectorizer(r, "content")
    fused = features.fused_features(fitted.transform(r, "content"), v.irony(spark, d))
    n = len(fitted.terms)
    vector = F.unwrap_udt("fused")
    # A null score is NaN in the vector; show it as null, like SQL does.
    dense = F.when(vector["indices"].isNull(), F.sequence(F.lit(0), F.size(vector["values"]) - 1)).otherwise(
        vector["indices"]
    )
    long = fused.select("review_id", F.inline(F.arrays_zip(dense.alias("i"), vector["values"].alias("x"))))
    names = features.term_array([*fitted.terms, "irony_label", "irony_score"])
    named = long.toDF("review_id", "i", "x").filter("x <> 0").select(
        "review_id",
        (F.col("i") >= n).alias("extra"),
        F.element_at(names, F.col("i") + 1).alias("feature"),
        F.when(~F.isnan("x"), F.round("x", 6)).alias("value"),
    )
    return named


def score_dummy(spark, d):
    scored = models.Fitted(models.UNIFORM).transform(v.reviews(spark, d).select("review_id"))
    label = lb.polarity_label(F.col(f"{models.UNIFORM}_label"))
    return scored.select(
        "review_id", label.alias("predicted_label"), F.col(f"{models.UNIFORM}_prob").alias("predicted_positive_probability")
    )


def _labelled_text(spark, d) -> DataFrame:
    r = v.reviews(spark, d).select("review_id", "movie_id", "movie_title", F.col("content").alias("preprocessed_text"))
    with_entities = entities.augment_text(r, entities.entity_features(v.entities(spark, d)))
    labelled = with_entities.join(v.truth(spark, d).select("review_id", "polarity"), "review_id")
    return session.materialise(sample.stratified_split(labelled, ["polarity"], 0.2, seed=99), "labelled")


def _score_with(spark, d, names: tuple[str, ...]) -> DataFrame:
    train = _labelled_text(spark, d).filter("split = 'train'")
    trained = models.train_source(train, "preprocessed_text", names)
    corpus = v.reviews(spark, d).withColumnRenamed("content", "preprocessed_text")
    return models.score_corpus(corpus, trained)


def _sound(scored: DataFrame) -> DataFrame:
    """What has to hold for any fit: a row for each review, a share for a probability, and a label - of the
    logistic model the one its share stands for, while the margin's share is fitted apart from its label."""
    share, label = F.col("predicted_positive_probability"), F.col("predicted_label")
    stands_for = (label == lb.POSITIVE) == (share >= 0.5)
    fits = F.when(F.col("model") == models.LOGISTIC, stands_for).otherwise(label.isin(lb.POSITIVE, lb.NEGATIVE))
    return scored.select("review_id", "movie_id", "model", "text_source", share.between(0, 1).alias("is_share"), fits.alias("label_fits"))


def score_lr(spark, d):
    return _sound(_score_with(spark, d, (models.LOGISTIC,)))


def score_svm(spark, d):
    return _sound(_score_with(spark, d, (models.SVM,)))


def score_corpus(spark, d):
    balance = metrics.prediction_balance(_score_with(spark, d, models.MODELS))
    both = F.col("predicted_negative") + F.col("predicted_positive")
    share = F.abs(F.col("predicted_positive_share") - F.col("predicted_positive") / F.col("rows_scored")) < 1e-6
    return balance.select("model", "text_source", "rows_scored", (both == F.col("rows_scored")).alias("all_labelled"), share.alias("share_fits"))


def model_matrix(spark, d):
    rows_ = _labelled_text(spark, d)
    done = models.evaluate_sources(rows_.filter("split = 'train'"), rows_.filter("split = 'test'"))
    measures = F.array("accuracy", "macro_f1", "weighted_f1")
    return done.summary.select("text_source", "model", F.forall(measures, lambda m: m.between(0, 1)).alias("are_shares"))


QUERIES: dict[str, Query] = {
    "flatten_pages": flatten_pages,
    "page_status": status_of_pages,
    "upsert_reviews": upsert,
    "clean_reviews": clean_reviews,
    "valid_ratings": valid_ratings,
    "index_docs": index_docs,
    "combine_text": combine_text,
    "basic_clean": basic_clean,
    "expand_slang": expand_slang,
    "deep_clean": deep_clean,
    "lemma_stop": lemma_stop,
    "preprocess": preprocess,
    "find_titles": find_titles,
    "filter_sentences": filter_sentences,
    "preprocess_for_title": preprocess_for_title,
    "entity_features": entity_features,
    "augment_text": augment_text,
    "merge_annotators": merge_annotators,
    "normalize_labels": normalize_labels,
    "label_distribution": label_distribution,
    "fleiss_kappa": fleiss_kappa,
    "majority_vote": majority_vote,
    "attach_text": attach_text,
    "unlabeled": unlabeled,
    "overlap_count": overlap_count,
    "attach_sentiment": attach_sentiment,
    "movie_counts": movie_counts,
    "value_counts": value_counts,
    "corpus_stats": corpus_stats,
    "top_words": top_words,
    "label_sample": label_sample,
    "equal_rating_sample": equal_rating_sample,
    "stratified_split": stratified_split,
    "class_report": class_report,
    "model_summary": model_summary,
    "best_model": best_model,
    "best_predictions": best_predictions,
    "labeled_report": labeled_report,
    "prediction_balance": prediction_balance,
    "compare_models": compare_models,
    "search_bm25": search_bm25,
    "search_terms_or": search_terms_or,
    "search_phrase": search_phrase,
    "search_filtered": search_filtered,
    "search_reviews": search_reviews,
    "search_by_helpfulness": search_by_helpfulness,
    "search_by_rating": search_by_rating,
    "search_by_date": search_by_date,
    "search_boosted": search_boosted,
    "search_postings": search_postings,
    "index_bm25": index_bm25,
    "index_phrase": index_phrase,
    "index_filtered": index_filtered,
    "index_facets": index_facets,
    "index_windows": index_windows,
    "search_postings_phrase": search_postings_phrase,
    "postings": build_postings,
    "term_stats": term_stats,
    "title_exact_vs_terms": title_exact_vs_terms,
    "helpfulness_compare": helpfulness_compare,
    "date_windows": date_windows,
    "facet_movie": facet_movie,
    "facet_movie_all": facet_movie_all,
    "facet_year": facet_year,
    "facet_rating": facet_rating,
    "facet_sentiment": facet_sentiment,
    "facet_multi": facet_multi,
    "tfidf_terms": tfidf_terms,
    "fused_features": fused_features,
    "score_dummy": score_dummy,
    "score_lr": score_lr,
    "score_svm": score_svm,
    "score_corpus": score_corpus,
    "model_matrix": model_matrix,
}
