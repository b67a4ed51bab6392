"""Which titles a text names, and which sentences to keep for one title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import text as tx
from marquee.functions.binding import add_once, let

# Up to this many title keys go into the plan as a literal array.
LITERAL_LIMIT = 500
_GRAM = 4


def title_keys(movies: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """(key, title): the plain-letter form of every title and alias.

    When two titles share a key the alias wins, then the greater title: one
    key stands for one title.
    """
    keys = movies.select(tx.plain_letters(F.col("movie_title")).alias("key"), F.col("movie_title").alias("title"))
    keys = keys.withColumn("_rank", F.lit(0))
    if aliases is not None:
        named = aliases.select(tx.plain_letters(F.col("alias")).alias("key"), F.col("movie_title").alias("title"))
        keys = keys.unionByName(named.withColumn("_rank", F.lit(1)))
    return (
        keys.filter(F.col("key") != "")
        .groupBy("key")
        .agg(F.max(F.struct("_rank", "title"))["title"].alias("title"))
    )


def _literal_titles(keys: DataFrame) -> list[tuple[str, str]] | None:
    rows = keys.select("key", "title").limit(LITERAL_LIMIT + 1).collect()
    return None if len(rows) > LITERAL_LIMIT else sorted((r["key"], r["title"]) for r in rows)


def _names(plain: Column, key: Column, whole_words: bool) -> Column:
    if not whole_words:
        return F.contains(plain, key)
    spaced = F.concat(F.lit(" "), F.regexp_replace(plain, rf"[{tx.SPACE_CLASS}]+", " "), F.lit(" "))
    return F.contains(spaced, F.concat(F.lit(" "), key, F.lit(" ")))


def _title_array(titles: list[tuple[str, str]]) -> Column:
    return F.array(*[F.struct(F.lit(k).alias("key"), F.lit(t).alias("title")) for k, t in titles])


def titles_in(plain: Column, titles: list[tuple[str, str]], whole_words: bool = False) -> Column:
    """Distinct titles whose key occurs in ``plain`` (text in plain letters)."""
    if not titles:
        return F.array().cast("array<string>")
    hits = F.filter(_title_array(titles), lambda t: _names(plain, t["key"], whole_words))
    return F.array_distinct(F.transform(hits, lambda t: t["title"]))


def find_titles(
    df: DataFrame,
    keys: DataFrame,
    text: str = "text",
    out: str = "titles",
    whole_words: bool = False,
) -> DataFrame:
    """Add the sorted array of titles named in ``text``; empty for a null text.

    The test is a substring test unless ``whole_words`` is set: ``thor`` is
    found in ``author``.  A small title list is checked inside the row; a large
    one is joined on character grams, see ``_find_by_grams``.
    """
    titles = _literal_titles(keys)
    if titles is not None:
        found = let(tx.plain_letters(F.col(text)), lambda plain: F.sort_array(titles_in(plain, titles, whole_words)))
        return df.withColumn(out, found)
    # Rows are matched by a digest of their text: ids may be missing or repeated, equal texts are searched once.
    plain = tx.plain_letters(F.col(text))
    keyed = add_once(df, {"_unit": F.md5(plain)})
    units = df.select(F.md5(plain).alias("_unit"), plain.alias("_plain")).filter("_plain IS NOT NULL").dropDuplicates(["_unit"])
    hits = _find_by_grams(units, keys, whole_words).groupBy("_unit").agg(F.sort_array(F.collect_set("title")).alias("_found"))
    empty = F.array().cast("array<string>")
    return keyed.join(hits, "_unit", "left").withColumn(out, F.coalesce("_found", empty)).drop("_unit", "_found")


def _grams(text: Column, size: int) -> Column:
    """Distinct character grams of one size."""
    last = F.length(text) - size + 1
    places = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(places, lambda p: F.substring(text, p, F.lit(size))))


def _find_by_grams(units: DataFrame, keys: DataFrame, whole_words: bool) -> DataFrame:
    """(unit, title) pairs by an equi-join, exact for any number of titles.

    Each key is represented by the one of its grams that the fewest texts hold;
    a text that contains the key contains that gram too.  So texts meet keys on
    the gram, and the pair is then checked in full.
    """
    sized = keys.withColumn("_size", F.least(F.length("key"), F.lit(_GRAM)))
    sizes = range(1, _GRAM + 1)

    def grams_for(text: Column, size: Column) -> Column:
        picked = F.when(size == _GRAM, _grams(text, _GRAM))
        for s in sizes:
            picked = picked.when(size == s, _grams(text, s))
        return picked

    key_grams = sized.withColumn("_gram", F.explode(grams_for(F.col("key"), F.col("_size"))))
    present = [r["_size"] for r in sized.select("_size").distinct().collect()]  # at most _GRAM sizes
    text_grams = units.select(
        "_unit",
        "_plain",
        F.explode(F.array(*[F.lit(s) for s in sorted(present)])).alias("_size"),
    ).select("_unit", "_size", F.explode(grams_for(F.col("_plain"), F.col("_size"))).alias("_gram"))
    text_grams = text_grams.join(key_grams.select("_size", "_gram").distinct(), ["_size", "_gram"], "left_semi")
    held = text_grams.groupBy("_size", "_gram").agg(F.count(F.lit(1)).alias("_texts"))
    anchors = (
        key_grams.join(held, ["_size", "_gram"], "left")
        .groupBy("key", "title", "_size")
        .agg(F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("_texts"), "_gram"))["_gram"].alias("_gram"))
    )
    # The gram join carries digests only; the text is fetched again for candidates.
    candidates = text_grams.join(anchors, ["_size", "_gram"]).select("_unit", "key", "title")
    checked = candidates.join(units, "_unit").filter(_names(F.col("_plain"), F.col("key"), whole_words))
    return checked.select("_unit", "title").distinct()


def _concerns(named: Column, target: Column) -> Column:
    return (F.size(named) == 0) | F.exists(named, lambda n: tx.plain_letters(n) == target)


def filter_sentences(
    df: DataFrame,
    keys: DataFrame,
    text: str = "text",
    title: str = "movie_title",
    out: str = "text",
    doc_id: str = "review_id",
    works: DataFrame | None = None,
    whole_words: bool = False,
) -> DataFrame:
    """Keep the sentences that name no title, or that name the review's own.

    ``works`` (``doc_id``, value) adds titles found by an entity tagger: a
    sentence that contains the value names it.
    """
    target = "_target"
    with_target = add_once(df, {target: tx.plain_letters(F.col(title))})
    if works is not None:
        named = works.groupBy(doc_id).agg(F.sort_array(F.collect_set("value")).alias("_works"))
        with_target = with_target.join(named, doc_id, "left")
    else:
        with_target = with_target.withColumn("_works", F.lit(None).cast("array<string>"))
    works_in = lambda s: F.filter(
        F.coalesce(F.col("_works"), F.array().cast("array<string>")), lambda w: F.contains(s, w)
    )

    titles = _literal_titles(keys)
    if titles is not None:

        def judged_sentence(sentence: Column) -> Column:
            by_rule = let(tx.plain_letters(sentence), lambda plain: titles_in(plain, titles, whole_words))
            return F.struct(sentence.alias("raw"), F.array_union(by_rule, works_in(sentence)).alias("named"))

        judged = F.transform(tx.sentences(F.col(text)), judged_sentence)
        kept = F.filter(judged, lambda x: _concerns(x["named"], F.col(target)))
        joined = F.array_join(F.transform(kept, lambda x: x["raw"]), " ")
        return with_target.withColumn(out, joined).drop(target, "_works")

    # Many titles: sentences become rows, meet titles by grams, and go back.  What
    # is kept depends on text, target and works alone, so rows are matched by a
    # digest of the three: ids may be missing or repeated.
    blank = F.struct(F.col(text).isNull(), F.col(target).isNull())
    content = F.md5(F.to_json(F.struct(F.col(text).alias("t"), F.col(target).alias("g"), F.col("_works").alias("w"), blank.alias("b"))))
    keyed = with_target.withColumn("_content", content)
    rows = keyed.dropDuplicates(["_content"]).select(
        "_content", target, "_works", F.posexplode(tx.sentences(F.col(text))).alias("_pos", "_sentence")
    )
    rows = add_once(rows, {"_plain": tx.plain_letters(F.col("_sentence"))}).withColumn("_unit", F.md5("_plain"))
    units = rows.select("_unit", "_plain").dropDuplicates(["_unit"])
    named = _find_by_grams(units, keys, whole_words).groupBy("_unit").agg(F.collect_set("title").alias("_named"))
    judged = rows.join(named, "_unit", "left").withColumn(
        "_named",
        F.array_union(F.coalesce("_named", F.array().cast("array<string>")), works_in(F.col("_sentence"))),
    )
    regrouped = (
        judged.filter(_concerns(F.col("_named"), F.col(target)))
        .groupBy("_content")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "_sentence"))).alias("_kept"))
        .select("_content", F.array_join(F.col("_kept._sentence"), " ").alias("_text"))
    )
    joined = keyed.join(regrouped, "_content", "left")
    kept_text = F.when(F.col(text).isNotNull(), F.coalesce("_text", F.lit("")))
    return joined.withColumn(out, kept_text).drop("_text", "_content", target, "_works")
