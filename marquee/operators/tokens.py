"""Word-level steps: slang, lemmas, stop words, the whole preprocessing chain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import text as tx

# Words the corpus uses too often to tell reviews apart.
CORPUS_STOP_WORDS = [
    "movie", "film", "marvel", "character", "characters",
    "man", "story", "watch", "scene", "scenes",
    "universe", "avenger", "avengers", "s",
]

# Up to this many entries a dictionary goes into the plan as a literal.
LITERAL_LIMIT = 2_000


def merge_dictionaries(general: DataFrame, domain: DataFrame) -> DataFrame:
    """Both dictionaries in one; the domain entry wins on a clash."""
    return general.join(domain.select("term"), "term", "left_anti").unionByName(domain)


def entries_of(dictionary: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value) with one row per key: entries without key or value do not count, the greatest value wins."""
    usable = dictionary.filter(F.col(key).isNotNull() & F.col(value).isNotNull())
    return usable.groupBy(F.col(key).alias("_word")).agg(F.max(value).alias("_new"))


def small_dictionary(entries: DataFrame, limit: int = LITERAL_LIMIT) -> dict | None:
    """The entries as a dict when there are at most ``limit``, else None."""
    rows = entries.select("_word", "_new").limit(limit + 1).collect()
    return None if len(rows) > limit else {r["_word"]: r["_new"] for r in rows}


def _with_content(df: DataFrame, tokens: str) -> DataFrame:
    """Adds a digest of the tokens.  What a row's tokens become depends on nothing else, so rows are
    matched by it: ids may be missing or repeated, and equal rows are looked up once."""
    return df.withColumn("_content", F.md5(F.to_json(F.col(tokens))))


def _distinct_words(df: DataFrame, tokens: str) -> DataFrame:
    return df.select("_content", F.explode(F.array_distinct(tokens)).alias("_word")).distinct()


def replace_tokens(df: DataFrame, tokens: str, dictionary: DataFrame, key: str, value: str) -> DataFrame:
    """Swap each token found in ``dictionary``; see ``entries_of`` for repeated keys and missing values.

    A small dictionary is a literal lookup inside the row, without a shuffle.
    A large one is joined with the distinct words of each text, and only the
    hits travel back.  Both give the same rows.
    """
    entries = entries_of(dictionary, key, value)
    mapping = small_dictionary(entries)
    if mapping is not None:
        return df.withColumn(tokens, tx.lookup_each(F.col(tokens), mapping))
    keyed = _with_content(df, tokens)
    hits = (
        _distinct_words(keyed, tokens)
        .join(entries, "_word")
        .groupBy("_content")
        .agg(F.map_from_entries(F.collect_list(F.struct("_word", "_new"))).alias("_hits"))
    )
    swapped = F.transform(tokens, lambda t: F.coalesce(F.try_element_at(F.col("_hits"), t), t))
    return (
        keyed.join(hits, "_content", "left")
        .withColumn(tokens, F.when(F.col("_hits").isNull(), F.col(tokens)).otherwise(swapped))
        .select(*df.columns)
    )


def drop_tokens(df: DataFrame, tokens: str, unwanted: DataFrame, key: str, also: Sequence[str] = ()) -> DataFrame:
    """Remove the tokens listed in ``unwanted`` and in ``also``; same two ways as above."""
    listed = small_dictionary(entries_of(unwanted, key, key))
    if listed is not None:
        return df.withColumn(tokens, tx.drop_each(F.col(tokens), list(dict.fromkeys([*listed, *also]))))
    keyed = _with_content(df.withColumn(tokens, tx.drop_each(F.col(tokens), list(also))), tokens)
    hits = (
        _distinct_words(keyed, tokens)
        .join(unwanted.select(F.col(key).alias("_word")), "_word", "left_semi")
        .groupBy("_content")
        .agg(F.collect_set("_word").alias("_hits"))
    )
    kept = F.filter(tokens, lambda t: ~F.array_contains(F.col("_hits"), t))
    return (
        keyed.join(hits, "_content", "left")
        .withColumn(tokens, F.when(F.col("_hits").isNull(), F.col(tokens)).otherwise(kept))
        .select(*df.columns)
    )


def expand_slang(df: DataFrame, dictionary: DataFrame, text: str = "text", out: str = "text") -> DataFrame:
    """Whole-token dictionary lookup; tokens joined again with one space."""
    split = df.withColumn("_tokens", tx.words(F.col(text)))
    swapped = replace_tokens(split, "_tokens", dictionary, "term", "expansion")
    return swapped.withColumn(out, F.array_join("_tokens", " ")).drop("_tokens")


def lemmatize_filter(
    df: DataFrame,
    lemmas: DataFrame,
    stopwords: DataFrame,
    text: str = "text",
    out: str = "tokens",
) -> DataFrame:
    """Words to lower-case lemmas, without stop words and bare punctuation.

    ``lemmas`` has (word, lemma), ``stopwords`` has (word); the corpus stop
    words are always added.
    """
    found = df.withColumn(out, tx.words(F.col(text)))
    lowered = lemmas.select("word", F.lower("lemma").alias("lemma"))
    swapped = replace_tokens(found, out, lowered, "word", "lemma")
    swapped = swapped.withColumn(
        out, F.filter(F.transform(out, lambda t: F.lower(t)), lambda t: t.rlike(r"[\p{L}\p{N}]"))
    )
    return drop_tokens(swapped, out, stopwords, "word", CORPUS_STOP_WORDS)


def clean_words(df: DataFrame, dictionary: DataFrame, text: str, out: str) -> DataFrame:
    """Basic clean, slang, deep clean - in this order."""
    cleaned = df.withColumn(out, tx.basic_clean(F.col(text)))
    return expand_slang(cleaned, dictionary, out, out).withColumn(out, tx.deep_clean(F.col(out)))


def preprocess(
    df: DataFrame,
    dictionary: DataFrame,
    lemmas: DataFrame,
    stopwords: DataFrame,
    text: str = "text",
    out: str = "processed_text",
) -> DataFrame:
    """Clean words, lemmas, no stop words; joined with one space."""
    cleaned = clean_words(df, dictionary, text, out)
    tokens = lemmatize_filter(cleaned, lemmas, stopwords, out, "_lemmas")
    return tokens.withColumn(out, F.array_join("_lemmas", " ")).drop("_lemmas")
