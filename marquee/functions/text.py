"""Text cleaning as column expressions (all JVM-side)."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space beyond what \s covers in the JVM's regular expressions.
SPACE_CLASS = r"\s\x0b\x85\p{Z}"
WORD_RUN = rf"[^{SPACE_CLASS}]+"
URL = rf"http{WORD_RUN}"
BRACKETS = r"[-()\[\]{}]"

_TYPOGRAPHIC = {
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "–": "-",
    "—": "-",
    "…": "...",
}


def mangled_forms() -> list[tuple[str, str]]:
    """Typographic marks whose UTF-8 bytes were once read as Windows-1252."""
    forms = []
    for mark in _TYPOGRAPHIC:
        try:
            forms.append((mark.encode("utf-8").decode("cp1252").lower(), mark))
        except UnicodeDecodeError:
            continue
    return forms


def letter_folds() -> tuple[str, str]:
    """Accented Latin letters and odd spaces with their plain form, one to one."""
    source, target = [], []
    for code in range(0x00C0, 0x0250):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base.isascii() and base.isalpha():
            source.append(chr(code))
            target.append(base)
    spaces = [chr(c) for c in range(0x00A0, 0x3001) if unicodedata.category(chr(c)) == "Zs"]
    return "".join(source + spaces), "".join(target) + " " * len(spaces)


def wide_folds() -> list[tuple[str, str]]:
    """Characters whose plain form is not exactly one letter."""
    letters = [("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("ł", "l"), ("đ", "d")]
    upper = [("Æ", "AE"), ("Œ", "OE"), ("Ø", "O"), ("Ł", "L"), ("Đ", "D")]
    return letters + upper + list(_TYPOGRAPHIC.items())


def _replace_all(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), pairs, text)


def fold_latin(text: Column) -> Column:
    """Latin letters and typographic marks to ASCII; other scripts stay."""
    source, target = letter_folds()
    return F.translate(_replace_all(text, wide_folds()), source, target)


def combine_text(summary: Column, content: Column) -> Column:
    return F.concat(F.coalesce(summary, F.lit("")), F.lit(" "), F.coalesce(content, F.lit("")))


def basic_clean(text: Column) -> Column:
    """Lower case, no URLs, repaired marks, ASCII letters, brackets to spaces."""
    text = F.regexp_replace(F.lower(text), URL, "")
    text = fold_latin(_replace_all(text, mangled_forms()))
    return F.regexp_replace(text, BRACKETS, " ")


def deep_clean(text: Column) -> Column:
    return F.regexp_replace(text, rf"[^a-zA-Z0-9{SPACE_CLASS}]", "")


def words(text: Column) -> Column:
    """Split on runs of white space; blank text gives an empty array."""
    return F.regexp_extract_all(text, F.lit(WORD_RUN), 0)


def plain_letters(text: Column) -> Column:
    """Lower case with everything but ASCII letters, digits and spaces deleted."""
    return F.regexp_replace(F.lower(text), rf"[^a-z0-9{SPACE_CLASS}]", "")


def space_tokens(text: Column) -> Column:
    """Tokens between single spaces; other white space stays inside a token."""
    return F.filter(F.split(plain_letters(text), " "), lambda t: t != "")


def sentences(text: Column) -> Column:
    """Rule-based split: white space after ``.``, ``!`` or ``?`` ends a sentence."""
    return F.split(text, rf"(?<=[.!?])[{SPACE_CLASS}]+")


def lookup_each(tokens: Column, mapping: dict[str, str]) -> Column:
    """Swap every token that is a key of ``mapping`` (a small, literal dictionary).

    The membership test is a hash lookup in the JVM; only tokens that pass it
    read the map.
    """
    if not mapping:
        return tokens
    pairs = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    keys = list(mapping)
    return F.transform(tokens, lambda t: F.when(t.isin(keys), pairs[t]).otherwise(t))


def drop_each(tokens: Column, unwanted: list[str]) -> Column:
    if not unwanted:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(unwanted))
