import pytest
from pyspark.sql import functions as F

from marquee.functions import text as tx
from marquee.functions.analysis import ENGLISH, PLAIN
from marquee.functions.stemming import stem
from marquee.operators import titles as ti
from marquee.operators import tokens as tk
from marquee.operators.entities import augment_text, entity_features
from marquee.operators.stats import corpus_stats, movie_counts, top_words, value_counts


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "text string").select(expression(F.col("text"))).first()[0]


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("See HTTP://x.y/z?q now", "see  now"),
        ("Café naïve Straße Œuvre", "cafe naive strasse oeuvre"),
        ("don’t “stop”…", 'don\'t "stop"...'),
        ("a-b (c) [d] {e}", "a b  c   d   e "),
        ("itâ€™s", "it's"),
        ("один", "один"),
    ],
)
def test_basic_clean(spark, raw, cleaned):
    assert one(spark, tx.basic_clean, raw) == cleaned


def test_deep_clean_leaves_no_gap(spark):
    assert one(spark, tx.deep_clean, "well-known / #1 thing's") == "wellknown  1 things"


def test_space_tokens_keep_other_white_space(spark):
    assert one(spark, tx.space_tokens, "One  two\nthree, FOUR!") == ["one", "two\nthree", "four"]


def test_words_of_blank_text(spark):
    assert one(spark, tx.words, " \t ") == []


GENERAL = [("brb", "be right back"), ("mcu", "general"), ("IG", "never"), ("$", " dollar ")]


def dictionaries(spark):
    schema = "term string, expansion string"
    return tk.merge_dictionaries(
        spark.createDataFrame(GENERAL, schema), spark.createDataFrame([("mcu", "domain")], schema)
    )


def test_slang_domain_wins_and_tokens_are_whole(spark):
    df = spark.createDataFrame([("r1", " brb  mcu brbx ig "), ("r2", "")], "review_id string, text string")
    rows = {r.review_id: r.text for r in tk.expand_slang(df, dictionaries(spark)).collect()}
    assert rows == {"r1": "be right back domain brbx ig", "r2": ""}


def test_large_dictionary_gives_the_same(spark, monkeypatch):
    df = spark.createDataFrame(
        [("r1", "brb mcu mcu x"), ("r2", ""), ("r3", "none here"), ("r4", None)], "review_id string, text string"
    )
    small = tk.expand_slang(df, dictionaries(spark)).collect()
    monkeypatch.setattr(tk.small_dictionary, "__defaults__", (1,))
    large = tk.expand_slang(df, dictionaries(spark)).collect()
    assert sorted(map(str, small)) == sorted(map(str, large))


# Ids that repeat or are missing, keys that repeat, values that are null.
ODD_ROWS = [("r1", "brb x"), ("r1", "y brb"), (None, "brb"), (None, "other"), ("r2", None), ("r3", ""), ("r3", "brb x")]


@pytest.mark.parametrize("limit", [2000, 0])
def test_odd_ids_and_entries_in_dictionaries(spark, monkeypatch, limit):
    monkeypatch.setattr(tk.small_dictionary, "__defaults__", (limit,))
    df = spark.createDataFrame(ODD_ROWS, "review_id string, text string")
    entries = [("brb", "be"), ("brb", "back"), ("x", None), (None, "z"), ("x", None), ("y", None), ("y", "yes")]
    found = tk.expand_slang(df, spark.createDataFrame(entries, "term string, expansion string"))
    want = [("r1", "be x"), ("r1", "yes be"), (None, "be"), (None, "other"), ("r2", None), ("r3", ""), ("r3", "be x")]
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, want))
    tokens = df.select("review_id", F.split("text", " ").alias("tokens"))
    stops = spark.createDataFrame([("x",), ("x",), (None,)], "word string")
    left = [(r[0], r[1]) for r in tk.drop_tokens(tokens, "tokens", stops, "word", ["y"]).collect()]
    want = [("r1", ["brb"]), ("r1", ["brb"]), (None, ["brb"]), (None, ["other"]), ("r2", None), ("r3", [""]), ("r3", ["brb"])]
    assert sorted(map(str, left)) == sorted(map(str, want))


@pytest.mark.parametrize("limit", [500, 0])
def test_odd_ids_in_titles(spark, monkeypatch, limit):
    monkeypatch.setattr(ti, "LITERAL_LIMIT", limit)
    rows = [
        ("r1", "Thor", "Thor rocks. Up is not. Bye."), ("r1", "Up", "Thor rocks. Up is not. Bye."), ("r1", "Up", "Up. Hi."),
        (None, "Thor", "See Up. Then Thor."), (None, None, "See Up. Plain."), ("r2", "Up", None), ("r2", "Up", ""),
    ]
    df = spark.createDataFrame(rows, "review_id string, movie_title string, text string")
    keys = keys_of(spark, TITLES)
    named = [tuple(r)[1:] for r in ti.find_titles(df, keys, whole_words=True).collect()]
    want = [(t, x, sorted(k for k in ("Thor", "Up") if x and k in x)) for _, t, x in rows]
    assert sorted(map(str, named)) == sorted(map(str, want))
    kept = sorted(str((r.review_id, r.movie_title, r.text)) for r in ti.filter_sentences(df, keys, whole_words=True).collect())
    want = [
        ("r1", "Thor", "Thor rocks. Bye."), ("r1", "Up", "Up is not. Bye."), ("r1", "Up", "Up. Hi."),
        (None, "Thor", "Then Thor."), (None, None, "Plain."), ("r2", "Up", None), ("r2", "Up", ""),
    ]
    assert kept == sorted(map(str, want))


@pytest.mark.parametrize("limit", [2000, 1])
def test_lemmas_and_stop_words(spark, monkeypatch, limit):
    monkeypatch.setattr(tk.small_dictionary, "__defaults__", (limit,))
    df = spark.createDataFrame([("r1", "the movies were Good , film !! ran"), ("r2", "the")], "review_id string, text string")
    lemmas = spark.createDataFrame([("movies", "movie"), ("ran", "Run"), ("were", "be")], "word string, lemma string")
    stops = spark.createDataFrame([("the",), ("be",)], "word string")
    rows = {r.review_id: r.tokens for r in tk.lemmatize_filter(df, lemmas, stops).collect()}
    assert rows == {"r1": ["good", "run"], "r2": []}


def keys_of(spark, titles, aliases=()):
    movies = spark.createDataFrame([(t,) for t in titles], "movie_title string")
    named = spark.createDataFrame(list(aliases), "alias string, movie_title string") if aliases else None
    return ti.title_keys(movies, named)


TEXTS = [
    ("r1", "Thor", "I am the author. Thor: Ragnarok rocks! What a day?"),
    ("r2", "Iron Man 2", "Iron Man 2 beats iron-man. See Thor. Fine."),
    ("r3", "Up", "Nothing here"),
    ("r4", "Up", ""),
    ("r5", "Up", "up up and away. Thor was up too. See IRON MAN!"),
]
TITLES = ["Thor", "Thor: Ragnarok", "Iron Man", "Iron Man 2", "Up", "Ant-Man"]


def mentions(spark):
    return spark.createDataFrame(TEXTS, "review_id string, movie_title string, text string")


@pytest.mark.parametrize("limit", [500, 0])
@pytest.mark.parametrize("whole", [False, True])
def test_titles_both_ways(spark, monkeypatch, limit, whole):
    monkeypatch.setattr(ti, "LITERAL_LIMIT", limit)
    keys = keys_of(spark, TITLES, [("ragnarok", "Thor: Ragnarok")])
    rows = {r.review_id: r.titles for r in ti.find_titles(mentions(spark), keys, whole_words=whole).collect()}
    assert rows["r1"] == ["Thor", "Thor: Ragnarok"]
    assert rows["r2"] == (["Iron Man", "Iron Man 2", "Thor"])
    assert rows["r3"] == [] and rows["r4"] == []
    assert rows["r5"] == ["Iron Man", "Thor", "Up"]


@pytest.mark.parametrize("limit", [500, 0])
def test_sentences_both_ways(spark, monkeypatch, limit):
    monkeypatch.setattr(ti, "LITERAL_LIMIT", limit)
    kept = ti.filter_sentences(mentions(spark), keys_of(spark, TITLES))
    rows = {r.review_id: r.text for r in kept.collect()}
    assert rows == {
        "r1": "I am the author. Thor: Ragnarok rocks! What a day?",  # 'author' names Thor
        "r2": "Iron Man 2 beats iron-man. Fine.",
        "r3": "Nothing here",
        "r4": "",
        "r5": "up up and away. Thor was up too.",
    }


@pytest.mark.parametrize("limit", [500, 0])
def test_tagged_works_count_as_titles(spark, monkeypatch, limit):
    monkeypatch.setattr(ti, "LITERAL_LIMIT", limit)
    works = spark.createDataFrame([("r3", "Casablanca"), ("r5", "Thor")], "review_id string, value string")
    df = spark.createDataFrame([("r3", "Up", "Casablanca is old. Fine.")], "review_id string, movie_title string, text string")
    assert ti.filter_sentences(df, keys_of(spark, TITLES), works=works).first().text == "Fine."


def test_title_search_has_no_nested_loop(spark, monkeypatch):
    monkeypatch.setattr(ti, "LITERAL_LIMIT", 0)
    plan = ti.find_titles(mentions(spark), keys_of(spark, TITLES))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_entity_features(spark):
    rows = [
        ("r1", 3, "ORG", "Big Co"), ("r1", 1, "PERSON", " Ann Lee "), ("r1", 5, "PERSON", "ann lee"),
        ("r1", 2, "GPE", "Rome"), ("r2", 1, "GPE", "Rome"), ("r3", 1, "EVENT", " "),
    ]
    found = entity_features(spark.createDataFrame(rows, "review_id string, pos int, label string, value string"))
    assert [tuple(r) for r in found.collect()] == [("r1", "ENTLBL_PERSON ENTTXT_ann_lee ENTLBL_ORG ENTTXT_big_co")]
    texts = spark.createDataFrame([("r1", "t"), ("r2", None)], "review_id string, preprocessed_text string")
    out = {r.review_id: r.augmented_text for r in augment_text(texts, found).collect()}
    assert out["r1"].startswith("t [SEP] ENTLBL_PERSON") and out["r2"] == "[SEP]"


def test_counts(spark):
    df = spark.createDataFrame([("a b a",), ("B\nc",), (None,)], "content string")
    assert tuple(corpus_stats(df).first()) == (3, 4, 3)
    assert tuple(corpus_stats(df, approximate=True).first()) == (3, 4, 3)
    assert tuple(corpus_stats(df.limit(0)).first()) == (0, 0, 0)
    assert [tuple(r) for r in top_words(df, "content", 2).collect()] == [("a", 2), ("B", 1)]
    values = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    assert [(r.value, r["count"], round(r.share, 3)) for r in value_counts(values, "x").collect()] == [(1, 2, 0.667), (2, 1, 0.333)]


def test_movie_without_reviews_counts_zero(spark):
    movies = spark.createDataFrame([("a", "B"), ("b", "A"), ("c", "C")], "movie_id string, movie_title string")
    reviews = spark.createDataFrame([("c",), ("zz",)], "movie_id string")
    assert [(r.movie_title, r.n_reviews) for r in movie_counts(reviews, movies).collect()] == [("C", 1), ("A", 0), ("B", 0)]


# Words and stems of the published description of the algorithm.
STEMS = {
    "caresses": "caress", "ponies": "poni", "cats": "cat", "agreed": "agre", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "sized": "size", "hopping": "hop", "falling": "fall",
    "hissing": "hiss", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "vietnamization": "vietnam", "hopefulness": "hope", "triplicate": "triplic", "electrical": "electr",
    "revival": "reviv", "adoption": "adopt", "probate": "probat", "rate": "rate", "controll": "control", "roll": "roll",
}


def test_stems():
    assert {w: stem(w) for w in STEMS} == STEMS


def test_analysers_agree_with_their_query_side(spark):
    text = "The Movie's HEROES aren't hopping; Größe 2 café_x o’neil’s"
    for analyzer in (PLAIN, ENGLISH):
        assert one(spark, analyzer.slots, text) == analyzer.query_slots(text)
    assert ENGLISH.query_slots("the hopping")[0] is None
