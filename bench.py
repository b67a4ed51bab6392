"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the
local cores.  Every query is run to its last row into a sink that keeps
nothing; ``index_*`` queries run over an index written by ``index_build``.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from catalog import queries as q
from catalog import views as v
from marquee.operators import facets, postings, search
from marquee.session import apply_settings

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))

HEADLINE = [
    "search_bm25", "search_reviews", "search_phrase", "search_by_helpfulness", "helpfulness_compare", "facet_multi",
    "date_windows", "postings", "clean_reviews", "preprocess", "filter_sentences", "corpus_stats", "top_words",
    "label_sample", "stratified_split", "fleiss_kappa", "majority_vote", "class_report", "tfidf_terms", "score_lr",
]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_settings(spark)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    begin = time.perf_counter()
    action()
    return round(time.perf_counter() - begin, 3)


def index_queries(spark, index):
    content = ("content",)
    one = search.SearchRequest(q.TERM, content)
    yield "index_bm25", lambda: drain(search.search_index(index, one))
    yield "index_reviews", lambda: drain(search.search_index(index, q.REVIEW_REQUEST))
    by_help = search.SearchRequest(q.TERM, content, sort="helpfulness_score")
    yield "index_by_helpfulness", lambda: drain(search.search_index(index, by_help))
    fields = ["movie_title", "year", "sentiment"]
    yield "index_facets", lambda: drain(facets.facet_many(search.matching_index(index, one), fields))
    yield "index_windows", lambda: drain(search.count_windows(search.matching_index(index, one), q.WINDOWS))


def main() -> None:
    spark = session()
    drain(q.QUERIES["search_bm25"](spark, SF_DIR))  # start-up and first compilation
    times = {}
    for name in HEADLINE:
        times[name] = timed(lambda: drain(q.QUERIES[name](spark, SF_DIR)))
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    path = tempfile.mkdtemp(prefix="bench-index-") + "/index"
    times["index_build"] = timed(lambda: postings.write_index(v.docs(spark, SF_DIR), path))
    index = postings.load_index(spark, path)
    for name, action in index_queries(spark, index):
        action()  # a search service answers from a warm engine
        times[name] = timed(action)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)

    n_reviews = index.docs.count()
    print(
        json.dumps(
            {
                "metric": "review_corpus_headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "cpus": int(CPUS),
                "reviews": n_reviews,
                "reviews_per_sec": {
                    name: round(n_reviews / times[name], 1)
                    for name in ("postings", "preprocess", "tfidf_terms", "score_lr", "index_build")
                },
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
