"""Analysers: text to index terms.

An analysed text is an array with one slot per word.  A slot that holds no
index term (a stop word) is null, so positions keep their gaps.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from marquee.functions.stemming import stem

# The usual English stop words of full-text engines.
ENGLISH_STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()


@dataclass(frozen=True)
class Analyzer:
    name: str
    slots: Callable[[Column], Column]
    query_slots: Callable[[str], list[str | None]]
    # Every word gives a term: no gaps to skip when counting.
    gapless: bool
    # A term occurs letter by letter in the lower-cased text.
    keeps_letters: bool

    def terms(self, text: str) -> list[str]:
        """The index terms of a query text, in order, repeats kept."""
        return [t for t in self.query_slots(text) if t is not None]


def _plain_slots(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), 0)


def _plain_query(text: str) -> list[str | None]:
    return list(re.findall(r"[^\W_]+", text.lower()))


@F.pandas_udf(ArrayType(StringType()))
def _stem_slots(slots: pd.Series) -> pd.Series:
    """Stems the distinct words of a batch once and puts them back in their places."""
    rows = slots.tolist()
    sizes = [0 if row is None else len(row) for row in rows]
    codes, words = pd.factorize(np.array([w for row in rows if row is not None for w in row], dtype=object))
    stems = np.array([*map(stem, words), None], dtype=object)[codes]  # code -1: a gap
    parts = np.split(stems, np.cumsum(sizes)[:-1]) if rows else []
    return pd.Series([None if row is None else part.tolist() for row, part in zip(rows, parts)], dtype=object)


def _english_slots(text: Column) -> Column:
    found = F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+(?:['’][\p{L}\p{N}]+)*"), 0
    )
    bare = F.transform(found, lambda w: F.regexp_replace(w, r"['’]s$", ""))
    kept = F.transform(bare, lambda w: F.when(~w.isin(ENGLISH_STOP_WORDS), w))
    return _stem_slots(kept)


def _english_query(text: str) -> list[str | None]:
    found = re.findall(r"[^\W_]+(?:['’][^\W_]+)*", text.lower())
    bare = [re.sub(r"['’]s$", "", w) for w in found]
    return [None if w in ENGLISH_STOP_WORDS else stem(w) for w in bare]


PLAIN = Analyzer("plain", _plain_slots, _plain_query, gapless=True, keeps_letters=True)
ENGLISH = Analyzer("english", _english_slots, _english_query, gapless=False, keeps_letters=False)
ANALYZERS = {a.name: a for a in (PLAIN, ENGLISH)}
