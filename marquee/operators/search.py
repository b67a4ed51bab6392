"""BM25 search over review documents.

A request runs against either

* the documents themselves (``search``): two scans, one for the corpus
  statistics and one that scores inside the row and keeps the best ``k`` -
  nothing but a few numbers and ``k`` rows per task is shuffled; or
* a written index (``search_index``): only the postings of the request's terms
  are read, summed per id and joined with the documents.

Both give the same rows and scores.  Statistics are always those of the whole
corpus: filters choose documents, they do not change scores.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions.analysis import PLAIN, Analyzer
from marquee.functions.binding import add_once, let
from marquee.operators.groups import top_per_group
from marquee.operators.postings import FIELDS, SearchIndex, bucket_of, slot_count
from marquee.session import materialise

# The usual BM25 parameters.
K1 = 1.2
B = 0.75

SORTS = ("score", "helpfulness_score", "author_rating", "submission_date")
SNIPPET_CHARS = 320
# Up to this many ids a result is fetched by id from the stored documents.
FETCH_ROWS = 1000


@dataclass(frozen=True)
class SearchRequest:
    """What to find, in which documents, and in what order.

    ``movie`` asks for all of its words in the title, ``title`` for the exact
    title.  Years widen to whole years; ``start`` and ``end`` are inclusive
    instants (``YYYY-MM-DD HH:MM:SS``); where both are given, both hold.  ``boost`` adds a document column to
    the score.
    """

    query: str
    fields: tuple[str, ...] = tuple(FIELDS)
    phrase: bool = False
    movie: str = ""
    title: str | None = None
    min_rating: float | None = None
    max_rating: float | None = None
    start_year: int | None = None
    end_year: int | None = None
    start: str | None = None
    end: str | None = None
    sort: str = "score"
    boost: str | None = None
    k: int = 10

    def __post_init__(self) -> None:
        if self.sort not in SORTS:
            raise ValueError(f"sort must be one of {SORTS}")
        unknown = [f for f in self.fields if f not in FIELDS]
        if unknown:
            raise ValueError(f"unknown fields: {unknown}")


@dataclass(frozen=True)
class _Clause:
    """A term, or a phrase with the place of each of its words, in one field."""

    field: str
    terms: tuple[str, ...]
    places: tuple[int, ...]
    weight: int = 1


@dataclass(frozen=True)
class _Query:
    clauses: list[_Clause] = field(default_factory=list)

    @property
    def fields(self) -> list[str]:
        return sorted({c.field for c in self.clauses})

    @property
    def pairs(self) -> list[tuple[str, str]]:
        return sorted({(c.field, t) for c in self.clauses for t in c.terms})


def _query_of(request: SearchRequest, analyzer: Analyzer) -> _Query:
    if request.phrase:
        placed = [(t, i) for i, t in enumerate(analyzer.query_slots(request.query)) if t is not None]
        if not placed:
            return _Query()
        terms, places = zip(*placed)
        from_first = tuple(p - places[0] for p in places)
        return _Query([_Clause(f, tuple(terms), from_first) for f in request.fields])
    terms = analyzer.terms(request.query)
    distinct = list(dict.fromkeys(terms))
    return _Query([_Clause(f, (t,), (0,), terms.count(t)) for f in request.fields for t in distinct])


def _both(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def _filters(request: SearchRequest, analyzer: Analyzer) -> Column:
    """Conditions on document columns, free of the query itself."""
    parts = []
    if request.title is not None:
        parts.append(F.col("movie_title") == request.title)
    if request.min_rating is not None:
        parts.append(F.col("author_rating") >= float(request.min_rating))
    if request.max_rating is not None:
        parts.append(F.col("author_rating") <= float(request.max_rating))
    first = f"{request.start_year:04d}-01-01 00:00:00" if request.start_year else None
    last = f"{request.end_year:04d}-12-31 23:59:59" if request.end_year else None
    for start in filter(None, (first, request.start)):  # every bound that is given holds
        parts.append(F.col("submission_date") >= F.lit(start).cast("timestamp"))
    for end in filter(None, (last, request.end)):
        parts.append(F.col("submission_date") <= F.lit(end).cast("timestamp"))
    for word in dict.fromkeys(analyzer.terms(request.movie)):
        parts.append(F.array_contains(analyzer.slots(F.col("movie_title")), word))
    return _both(parts)


def _idf(n_docs: Column, df: Column) -> Column:
    return F.log(1 + (n_docs - df + 0.5) / (df + 0.5))


def _bm25(idf: Column, freq: Column, length: Column, mean_length: Column) -> Column:
    norm = K1 * (1 - B + B * length / mean_length)
    return idf * freq / (freq + norm)


# --- over the documents -----------------------------------------------------


def _contains(term: str) -> Callable[[Column], Column]:
    return lambda slots: F.coalesce(F.array_contains(slots, term), F.lit(False))


def _frequency_of(clause: _Clause) -> Callable[[Column], Column]:
    """How often the clause occurs in an analysed text."""

    def single(slots: Column) -> Column:
        return F.size(F.filter(slots, lambda w: w == clause.terms[0]))

    def phrase(slots: Column) -> Column:
        last = F.size(slots) - 1 - clause.places[-1]
        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.size(
            F.filter(starts, lambda i: _both([slots[i + p] == t for t, p in zip(clause.terms, clause.places)]))
        )

    return single if len(clause.terms) == 1 else phrase


def _may_match(query: _Query, analyzer: Analyzer) -> Column:
    """A cheap necessary condition that saves analysing most documents."""
    if not analyzer.keeps_letters:
        return F.lit(True)
    by_field = []
    for c in query.clauses:
        text = F.lower(F.col(FIELDS[c.field]))
        by_field.append(_both([F.contains(text, F.lit(t)) for t in c.terms]))
    return reduce(lambda a, b: a | b, by_field)


def _measured(docs: DataFrame, analyzer: Analyzer, measures: dict[str, dict]) -> DataFrame:
    """Adds columns worked out from analysed fields; each field is analysed once.

    ``measures`` maps a field to ``{column: function of its slots}``.
    """

    def measured(named: dict) -> Callable[[Column], Column]:
        return lambda slots: F.struct(*[make(slots).alias(c) for c, make in named.items()])

    per_field = {
        f"_m_{f}": let(analyzer.slots(F.col(FIELDS[f])), measured(named)) for f, named in measures.items()
    }
    flat = {c: F.col(f"_m_{f}")[c] for f, named in measures.items() for c in named}
    return add_once(docs, per_field).withColumns(flat).drop(*per_field)


def _analysed(docs: DataFrame, query: _Query, analyzer: Analyzer) -> DataFrame:
    """Adds ``_f<i>`` (frequency of clause i) and ``_l_<field>`` (its length)."""
    measures: dict[str, dict] = {f: {f"_l_{f}": lambda s: slot_count(s, analyzer)} for f in query.fields}
    for i, clause in enumerate(query.clauses):
        measures[clause.field][f"_f{i}"] = _frequency_of(clause)
    return _measured(docs, analyzer, measures)


def _corpus_stats(docs: DataFrame, query: _Query, analyzer: Analyzer) -> Column:
    """N and mean length per field, df per (field, term), as one scalar struct."""
    measures: dict[str, dict] = {f: {f"_l_{f}": lambda s: slot_count(s, analyzer)} for f in query.fields}
    for i, (f, term) in enumerate(query.pairs):
        measures[f][f"_p{i}"] = _contains(term)
    rows = _measured(docs.select(*[FIELDS[f] for f in query.fields]), analyzer, measures)
    sums = rows.agg(
        *[F.count_if(F.col(f"_l_{f}") > 0).alias(f"n_{f}") for f in query.fields],
        *[F.sum(f"_l_{f}").alias(f"len_{f}") for f in query.fields],
        *[F.count_if(F.col(f"_p{i}")).alias(f"df{i}") for i in range(len(query.pairs))],
    )
    return sums.select(F.struct(*sums.columns)).scalar()


def _score(query: _Query, stats: Column) -> Column:
    df_of = {pair: stats[f"df{i}"] for i, pair in enumerate(query.pairs)}
    parts = []
    for i, c in enumerate(query.clauses):
        n = stats[f"n_{c.field}"]
        mean = F.try_divide(stats[f"len_{c.field}"], n)  # no document may have the field
        idf = reduce(lambda a, b: a + b, [_idf(n, df_of[(c.field, t)]) for t in c.terms])
        freq = F.col(f"_f{i}")
        part = _bm25(idf * c.weight, freq, F.col(f"_l_{c.field}"), mean)
        parts.append(F.when(freq > 0, part).otherwise(0.0))
    return reduce(lambda a, b: a + b, parts)


def _any_hit(query: _Query) -> Column:
    return reduce(lambda a, b: a | b, [F.col(f"_f{i}") > 0 for i in range(len(query.clauses))])


def _none(docs: DataFrame) -> DataFrame:
    return docs.filter(F.lit(False))


def matching(docs: DataFrame, request: SearchRequest, analyzer: Analyzer = PLAIN) -> DataFrame:
    """The documents a request finds, without scores; for counts and facets."""
    query = _query_of(request, analyzer)
    if not query.clauses:
        return _none(docs)
    found = docs.filter(_filters(request, analyzer) & _may_match(query, analyzer))
    return _analysed(found, query, analyzer).filter(_any_hit(query)).select(*docs.columns)


def scored(docs: DataFrame, request: SearchRequest, analyzer: Analyzer = PLAIN) -> DataFrame:
    """Matching documents with ``score`` (boost included), in no order."""
    query = _query_of(request, analyzer)
    if not query.clauses:
        return _none(docs).withColumn("score", F.lit(0.0))
    found = docs.filter(_filters(request, analyzer) & _may_match(query, analyzer))
    hits = _analysed(found, query, analyzer).filter(_any_hit(query))
    stats = _corpus_stats(docs, query, analyzer)
    # As a column: one subquery, however often the score refers to it.
    measured = hits.withColumn("_stats", stats).withColumn("score", _score(query, F.col("_stats")))
    return _boosted(measured, request).select(*docs.columns, "score")


def _boosted(hits: DataFrame, request: SearchRequest) -> DataFrame:
    if request.boost is None:
        return hits
    return hits.withColumn("score", F.col("score") + F.col(request.boost))


def _top(hits: DataFrame, request: SearchRequest) -> DataFrame:
    return hits.orderBy(F.col(request.sort).desc_nulls_last(), "id").limit(request.k)


def result_rows(hits: DataFrame) -> DataFrame:
    """The columns shown for a hit."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return hits.select(
        "id",
        blank("movie_title").alias("movie_title"),
        blank("summary").alias("summary"),
        F.substring(blank("content"), 1, SNIPPET_CHARS).alias("snippet"),
        blank("author").alias("author"),
        "author_rating",
        "upvotes",
        "downvotes",
        "helpfulness_score",
        F.coalesce(F.date_format("submission_date", "yyyy-MM-dd"), F.lit("")).alias("date"),
        F.round("score", 6).alias("score"),
    )


def search(docs: DataFrame, request: SearchRequest, analyzer: Analyzer = PLAIN) -> DataFrame:
    """The best ``k`` documents; an empty query finds nothing."""
    return result_rows(_top(scored(docs, request, analyzer), request))


# --- over a written index ---------------------------------------------------


def _index_scores(index: SearchIndex, query: _Query) -> DataFrame:
    """(id, score) of every matching document."""
    wanted = reduce(
        lambda a, b: a | b,
        [
            (F.col("field") == f) & F.col("term").isin([t for g, t in query.pairs if g == f])
            for f in query.fields
        ],
    )
    found = index.postings.filter(wanted)
    here = F.lit(True)
    if index.buckets is not None:
        here = F.col("bucket").isin([bucket_of(index.buckets, F.lit(f), F.lit(t)) for f, t in query.pairs])
    found = found.filter(here)
    if index.terms is None:
        df = found.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df"))
    else:  # counted when the index was written
        df = index.terms.filter(wanted & here).select("field", "term", "df")
    stats = (
        df.join(F.broadcast(index.stats), "field")
        .select("field", "term", _idf(F.col("n_docs"), F.col("df")).alias("idf"), (F.col("total_len") / F.col("n_docs")).alias("mean"))
    )
    # One row per (field, term) of the request on the broadcast side.
    weighed = found.join(F.broadcast(stats), ["field", "term"])
    if all(len(c.terms) == 1 for c in query.clauses):
        weight = reduce(
            lambda acc, c: acc.when((F.col("field") == c.field) & (F.col("term") == c.terms[0]), c.weight),
            query.clauses[1:],
            F.when(
                (F.col("field") == query.clauses[0].field) & (F.col("term") == query.clauses[0].terms[0]),
                query.clauses[0].weight,
            ),
        )
        part = _bm25(F.col("idf") * weight, F.col("tf"), F.col("field_len"), F.col("mean"))
        return weighed.groupBy("id").agg(F.sum(part).alias("score"))

    # A phrase: bring the position lists of its words together per field.
    clause = query.clauses[0]
    words = list(dict.fromkeys(clause.terms))
    gathered = weighed.groupBy("id", "field").agg(
        *[F.max(F.when(F.col("term") == w, F.col("positions"))).alias(f"_p{i}") for i, w in enumerate(words)],
        *[F.max(F.when(F.col("term") == w, F.col("idf"))).alias(f"_i{i}") for i, w in enumerate(words)],
        F.max("field_len").alias("field_len"),
        F.max("mean").alias("mean"),
    )
    # Starts of the phrase: places that fit every word, moved back by its offset.
    def moved_back(word: str, place: int) -> Column:
        return F.transform(f"_p{words.index(word)}", lambda pos: pos - place)

    moved = [moved_back(t, p) for t, p in zip(clause.terms, clause.places)]
    idf = reduce(lambda a, b: a + b, [F.col(f"_i{words.index(t)}") for t in clause.terms])
    freq = F.size(reduce(F.array_intersect, moved))
    hit = gathered.withColumn("_freq", freq).filter(F.col("_freq") > 0)
    part = _bm25(idf, F.col("_freq"), F.col("field_len"), F.col("mean"))
    return hit.groupBy("id").agg(F.sum(part).alias("score"))


def search_index(index: SearchIndex, request: SearchRequest) -> DataFrame:
    """``search`` over a written index, in two steps.

    First the best ``k`` ids are chosen from scores and, where filters, boost
    or sort ask for it, the narrow columns of the documents.  Then the texts of
    those documents alone are fetched from their buckets.
    """
    query = _query_of(request, index.analyzer)
    docs = index.docs.drop("bucket")
    if not query.clauses:
        return result_rows(_none(docs).withColumn("score", F.lit(0.0)))
    scores = _index_scores(index, query)
    by_score_only = replace(request, query="", k=1) == SearchRequest("", request.fields, request.phrase, k=1)
    if by_score_only:
        chosen = scores
    else:
        kept = docs.filter(_filters(request, index.analyzer))
        chosen = _boosted(kept.join(scores, "id"), request).select(*dict.fromkeys(["id", "score", request.sort]))
    best = _top(chosen, request).select("id", "score")
    if request.k > FETCH_ROWS:
        return result_rows(_top(docs.join(best, "id"), request))
    rows = best.collect()  # at most FETCH_ROWS ids and scores
    found = _fetch(index, [r["id"] for r in rows])
    spark = index.docs.sparkSession
    with_score = found.join(F.broadcast(spark.createDataFrame(rows, best.schema)), "id")
    return result_rows(_top(with_score, request))


def _fetch(index: SearchIndex, ids: list[str]) -> DataFrame:
    """The documents with these ids, read from their buckets only."""
    if not ids:
        return _none(index.docs.drop("bucket"))
    found = index.docs.filter(F.col("id").isin(ids))
    if index.buckets is not None:
        found = found.filter(F.col("bucket").isin([bucket_of(index.buckets, F.lit(i)) for i in ids]))
    return found.drop("bucket")


def matching_index(index: SearchIndex, request: SearchRequest) -> DataFrame:
    """``matching`` over a written index."""
    query = _query_of(request, index.analyzer)
    docs = index.docs.drop("bucket")
    if not query.clauses:
        return _none(docs)
    ids = _index_scores(index, query).select("id")
    return docs.filter(_filters(request, index.analyzer)).join(ids, "id", "left_semi")


# --- comparisons ------------------------------------------------------------


def exact_and_analysed_title(docs: DataFrame, title: str, analyzer: Analyzer = PLAIN) -> DataFrame:
    """Hits of a title as a whole string and as analysed words, in one scan."""
    words = analyzer.terms(title)
    slots = analyzer.slots(F.col("movie_title"))
    any_word = F.arrays_overlap(slots, F.array(*[F.lit(w) for w in words])) if words else F.lit(False)
    counted = docs.agg(
        F.count_if(F.col("movie_title") == title).alias("exact"),
        F.count_if(any_word).alias("analysed"),
    )
    return counted.select(
        F.inline(
            F.array(
                F.struct(F.lit("exact_title").alias("label"), F.col("exact").alias("num_found")),
                F.struct(F.lit("analysed_title").alias("label"), F.col("analysed").alias("num_found")),
            )
        )
    )


def compare_rankings(docs: DataFrame, request: SearchRequest, top_n: int = 5, analyzer: Analyzer = PLAIN) -> DataFrame:
    """Score, helpfulness and boosted order side by side.

    One row per order: hits, and the mean helpfulness of its first ``top_n``.
    The three orders are ranked in one pass over the matches; each task sends
    at most ``top_n`` rows per order.
    """
    hits = scored(docs, replace(request, boost=None), analyzer).select("id", "score", "helpfulness_score")
    hits = materialise(hits, "ranking")  # three numbers a hit, for the orders and the count
    helpful = F.col("helpfulness_score")
    orders = F.array(
        F.struct(F.lit("bm25").alias("variant"), F.col("score").alias("_by")),
        F.struct(F.lit("by_helpfulness").alias("variant"), helpful.alias("_by")),
        F.struct(F.lit("boosted").alias("variant"), (F.col("score") + helpful).alias("_by")),
    )
    ranked = hits.select("id", "helpfulness_score", F.inline(orders))
    best = top_per_group(ranked, ["variant"], [F.col("_by").desc(), F.col("id")], top_n)
    found = hits.agg(F.count(F.lit(1)).alias("n")).scalar()
    return best.groupBy("variant").agg(
        F.round(F.avg("helpfulness_score"), 6).alias("avg_helpfulness_top_n")
    ).withColumn("num_found", found)


def count_windows(hits: DataFrame, windows: dict[str, tuple[str, str] | None]) -> DataFrame:
    """Hits in each date window, all counted in one pass; None is no window."""

    def inside(window: tuple[str, str] | None) -> Column:
        if window is None:
            return F.lit(True)
        low, high = (F.lit(x).cast("timestamp") for x in window)
        return F.col("submission_date").between(low, high)

    counted = hits.agg(*[F.count_if(inside(w)).alias(label) for label, w in windows.items()])
    return counted.select(
        F.inline(
            F.array(*[F.struct(F.lit(label).alias("label"), F.col(label).alias("num_found")) for label in windows])
        )
    )
