"""Spelling variants of a vocabulary, by permuterm rotations.

A word is closed by a terminator and turned: ``abc$`` has the rotations ``abc$``,
``bc$a``, ``c$ab`` and ``$abc``.  Turn a word so that one letter stands last: what
stands before that letter, the head, is the same for all words that differ only
in this letter, and it is a whole rotation of the word that lacks the letter.  So
rotations are sorted by head and letter, and the neighbours of a word are what
shares a head with it: words with another last letter (replaced), and the word
whose rotation ends there (one letter less).  A head holds one word for each
letter of the alphabet and one without, so groups are small whatever the corpus,
and a scan over a group tells each member how many others there are and which is
the most frequent; no pairs are made.

A letter that repeats the one before it is the same deletion as the earlier one
and counts once: in a head, that is the letter equal to the last of the head.

Inputs and results that need saying: a null or empty text has no words; a null key
is damaged as the empty string; of near words with equal n the smallest by code
points is the form; equal rows all count; an empty table gives no rows; further
columns are not looked at.  A form has at least ``ratio`` (two or more) times the
n of its word, so chains of forms end, after as many steps as n has binary digits
at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.session import materialise, release

RUN = "[A-Za-zÀ-ÿ]+"
END = "$"  # no letter of a run
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def damaged(key: Column, run: Column, every: int) -> Column:
    """``run`` without one of its letters, if ``every`` divides the hash of key and run."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    return F.when(h % every == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)


def word_counts(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_length: int = 5, min_count: int = 3, every: int | None = None
) -> DataFrame:
    """(word, n) of the letter runs of all texts; ``every``: one run of so many loses a letter."""
    runs = F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(RUN), F.lit(0))
    found = docs.select(F.col(key).alias("key"), F.explode(runs).alias("run")).where(F.length("run") >= min_length)
    if every:
        found = found.select(damaged(F.col("key"), F.col("run"), every).alias("word")).where(F.length("word") >= min_length)
    else:
        found = found.select(F.col("run").alias("word"))
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """(head, letter, twin, word, n), sorted: what precedes the last letter of each turned word, and that letter.

    The whole turned word is a head too, with an empty letter.  ``twin``: the letter repeats the one before it.
    """
    word, length = F.col("word"), F.length("word")

    def turned(i: Column, skip: int) -> Column:
        return F.concat(word.substr(i + skip, length), F.lit(END), word.substr(F.lit(1), i - 1))

    def open_(i: Column) -> Column:
        letter = word.substr(i, F.lit(1))
        twin = (i > 1) & (letter == word.substr(i - 1, F.lit(1)))
        return F.struct(turned(i, 1).alias("head"), letter.alias("letter"), twin.alias("twin"))

    def whole(i: Column) -> Column:
        return F.struct(turned(i, 0).alias("head"), F.lit("").alias("letter"), F.lit(False).alias("twin"))

    every = F.concat(F.transform(F.sequence(F.lit(1), length), open_), F.transform(F.sequence(F.lit(1), length + 1), whole))
    turned_words = words.where(length > 0).select(F.inline(every), "word", "n")
    return turned_words.repartitionByRange("head").sortWithinPartitions("head", "letter")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best) of each word that has near ones; best is (-n, word) of the most frequent."""
    group = Window.partitionBy("head")
    order = group.orderBy("letter")
    met = rotations(words).withColumn("members", F.count("*").over(group)).where("members > 1")
    rank = F.struct((-F.col("n")).alias("less"), F.col("word").alias("word"))
    before = F.min(rank).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(rank).over(order.rowsBetween(1, Window.unboundedFollowing))
    whole = F.max((F.col("letter") == "").cast("int")).over(group)
    twins = F.sum(F.col("twin").cast("int")).over(group)
    # A twin and the word without its letter meet once more, at the letter it repeats.
    again = F.when(F.col("letter") == "", twins).when(F.col("twin"), whole).otherwise(0)
    seen = met.select("word", (F.col("members") - 1 - again).alias("others"), F.least(before, after).alias("best"))
    return seen.groupBy("word").agg(F.sum("others").cast("long").alias("n_near"), F.min("best").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of each (word, form): forms are followed to the last, twice as far in each round."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        joined = now.join(further, F.col("root") == F.col("at"), "left")
        moved = materialise(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots"
        )
        release(now)
        now = moved
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def variant_groups(words: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each (word, n); words are unique."""
    if ratio < 2:
        raise ValueError("a ratio below two lets forms go in circles")
    words = materialise(words.select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    joined = words.join(near_words(words), "word", "left")
    fits = -F.col("best.less") >= ratio * F.col("n")
    formed = joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(fits, F.col("best.word")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )
    formed = materialise(formed, "spelling-forms")
    roots = _roots(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
