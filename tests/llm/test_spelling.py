"""Spelling variants against all pairs of a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import pytest

from marquee.llm import spelling


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def by_hand(words, ratio=2):
    out = {}
    for w, n in words.items():
        close = [x for x in words if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = (len(close), form, words.get(form))
    roots = {}
    for w in words:
        at = w
        while out[at][1] is not None:
            at = out[at][1]
        roots[w] = at
    return {w: (words[w], *out[w], roots[w]) for w in words}


def found(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


@pytest.mark.parametrize("alphabet", ["ab", "abÉé", "abcdefgh"])
def test_against_all_pairs(spark, alphabet):
    rng = random.Random(len(alphabet))
    words = {"".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 7))): rng.choice([1, 2, 3, 4, 8, 9, 30]) for _ in range(150)}
    df = spark.createDataFrame([(w, n, "own", "x") for w, n in words.items()], "word string, n long, head string, best string")
    assert found(spelling.variant_groups(df)) == by_hand(words)


def test_chains_ties_and_runs_of_a_letter(spark):
    words = {"aaaaa": 3, "aaaa": 6, "aaab": 12, "aabb": 24, "zzzzz": 5, "zzzzx": 10, "zzzzy": 10, "alone": 4}
    got = found(spelling.variant_groups(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == by_hand(words)
    assert got["aaaaa"] == (3, 1, "aaaa", 6, "aabb") and got["zzzzz"][2] == "zzzzx" and got["alone"] == (4, 0, None, None, "alone")


def test_word_counts(spark):
    texts = [(1, "Straße straße ÉCOLE école Naïve, naïve 12345 Schluß-Schluß"), (1, "Naïve naïve"), (2, None), (3, ""), (None, "naïve " * 40)]
    texts += [(i, "spelling variants of common words") for i in range(10, 400)]
    df = spark.createDataFrame([(*r, "own", 5) for r in texts], "doc_id long, text string, word string, n int")
    want = Counter()
    for key, text in texts:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    for least in (1, 3):
        kept = {w: n for w, n in want.items() if len(w) >= 5 and n >= least}
        assert {r["word"]: r["n"] for r in spelling.word_counts(df, min_count=least, every=97).collect()} == kept
    assert {"spelling", "variants", "common", "words", "naïve"} < set(want)
    assert {r["word"] for r in spelling.word_counts(df).collect()} == {"spelling", "variants", "common", "words", "naïve"}


def test_empty(spark):
    none = spelling.word_counts(spark.createDataFrame([], "doc_id long, text string"), every=97)
    assert spelling.variant_groups(none).collect() == []
    with pytest.raises(ValueError):
        spelling.variant_groups(none, ratio=1)
