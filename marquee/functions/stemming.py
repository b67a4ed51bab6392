"""Porter's suffix stripping (M. F. Porter, "An algorithm for suffix
stripping", Program 14(3), 1980), for single lower-case words."""

from __future__ import annotations

import re
from functools import lru_cache

# The suffix tables of the published algorithm.
_STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
_STEP3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
_STEP4 = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize"
).split()


def _shape(word: str) -> str:
    """The word as a string of c (consonant) and v (vowel)."""
    out = []
    for i, ch in enumerate(word):
        vowel = ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c")
        out.append("v" if vowel else "c")
    return "".join(out)


def _measure(stem_: str) -> int:
    return len(re.findall("v+c+", _shape(stem_)))


def _ends_cvc(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _swap(word: str, table: dict[str, str]) -> str:
    for suffix in sorted(table, key=len, reverse=True):
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            return base + table[suffix] if _measure(base) > 0 else word
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if len(word) < 3 or not (word.isascii() and word.isalpha()):
        return word

    # 1a: plurals
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    # 1b: -eed, -ed, -ing
    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        ending = next((e for e in ("ed", "ing") if word.endswith(e) and "v" in _shape(word[: -len(e)])), None)
        if ending:
            word = word[: -len(ending)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c" and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _ends_cvc(word):
                word += "e"

    # 1c: final y
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"

    word = _swap(word, _STEP2)
    word = _swap(word, _STEP3)

    # 4: suffixes that go altogether after a longer stem
    for suffix in sorted(_STEP4, key=len, reverse=True):
        if word.endswith(suffix):
            base = word[: -len(suffix)]
            if _measure(base) > 1 and (suffix != "ion" or base.endswith(("s", "t"))):
                word = base
            break

    # 5: final e and double l
    if word.endswith("e"):
        base = word[:-1]
        if _measure(base) > 1 or (_measure(base) == 1 and not _ends_cvc(base)):
            word = base
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
