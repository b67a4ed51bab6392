"""The search experiments side by side, as rows and as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from marquee.functions.analysis import PLAIN, Analyzer
from marquee.operators import facets, search
from marquee.sources import write_table


def search_experiments(
    docs: DataFrame,
    title: str,
    ranking_word: str,
    facet_word: str,
    window_word: str,
    windows: dict[str, tuple[str, str] | None],
    analyzer: Analyzer = PLAIN,
    limit: int = 10,
) -> dict[str, DataFrame]:
    """One table per experiment; each reads the documents on its own."""
    content = ("content",)

    def hits(word: str) -> DataFrame:
        return search.matching(docs, search.SearchRequest(word, content, phrase=True), analyzer)

    found = hits(facet_word)
    return {
        "title_fields": search.exact_and_analysed_title(docs, title, analyzer),
        "rankings": search.compare_rankings(docs, search.SearchRequest(ranking_word, content), analyzer=analyzer),
        "facets": facets.facet_many(found, ["movie_title", "year", "sentiment"], limit),
        "rating_ranges": facets.facet_range(found, "author_rating"),
        "windows": search.count_windows(hits(window_word), windows),
        "sentiment": facets.facet_field(found, "sentiment"),
    }


def write_experiments(tables: dict[str, DataFrame], path: str, mode: str = "errorifexists") -> None:
    """Each experiment as JSON lines in a folder of its own."""
    for name, table in tables.items():
        write_table(table, f"{path}/{name}", "json", mode)
