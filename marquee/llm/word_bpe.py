"""Tokens of a word-level BPE vocabulary file, word by word.

White space separates words in this kind of vocabulary, so a text's tokens are
its words' tokens in a row.  The texts of a step are split into pre-tokens
together, by the classes of their characters; a pre-token of up to ``SHORT`` bytes
is two numbers, looked up in a bounded table, and unknown ones are merged
together, thousands at a time.  Longer ones and words outside the plain part of
Unicode are looked up one by one.  A word that is not plain, or one that may hold
a special token, goes to the tokenizer library as it is, which is the definition
of the right result.
"""

from __future__ import annotations

import gc
import json
import re
import struct
from itertools import chain, islice

import numpy as np
import regex
from tokenizers import Tokenizer

from marquee.llm.pair_merge import BoundedCache, PairMerger
from marquee.llm.texts import only_model

CACHED_WORDS = 400_000  # distinct words a worker remembers
CACHED_PIECES = 200_000  # distinct short pre-tokens a worker remembers
SHORT = 16  # bytes of a pre-token that two numbers hold
# The pattern that ``WordBpe.units`` follows; a vocabulary with another one is read word by word.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WHITE_SPACE, _LETTER, _NUMBER, _OTHER, _ODD = range(5)  # classes of characters, odd ones are not plain
_CODES = 0x250  # code points with a class of their own, of one or two bytes

# Plain words: letters without combining marks or special casing rules, where
# this module's lower case, normal form and classes are the library's.
_PLAIN = re.compile(r"[!-~\xa1-\u012f\u0132-\u022f]+")
# Characters that split() takes for white space and the library does not.
_SEPARATORS = re.compile(r"[\x1c-\x1f]")
_WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)  # masks of the first n bytes


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


def _class(char: str) -> int:
    if _WHITE.fullmatch(char):
        return _WHITE_SPACE
    if not _PLAIN.fullmatch(char):
        return _ODD
    return _LETTER if regex.match(r"\p{L}", char) else _NUMBER if regex.match(r"\p{N}", char) else _OTHER


class PieceTable:
    """Ids of short pre-tokens, whose bytes are a pair of numbers, in an open-addressing hash table."""

    def __init__(self, slots: int = 1 << 16):
        self.clear(slots)

    def clear(self, slots: int = 1 << 16) -> None:
        self._shift, self._mask = np.uint64(65 - slots.bit_length()), slots - 1
        self._low, self._high = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self._number = np.full(slots, -1, np.int32)
        self.starts, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._ids, self._used = np.zeros(1 << 16, np.int32), 0

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def ids(self) -> np.ndarray:
        """The ids of all entries; an entry's begin at its start."""
        return self._ids[: self._used]

    def _slot(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        mixed = (low ^ (high * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9E3779B97F4A7C15)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return (mixed >> self._shift).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of the entries, -1 where there is none."""
        slots = self._slot(low, high)
        found = self._number[slots]
        wrong = np.flatnonzero((found >= 0) & ((self._low[slots] != low) | (self._high[slots] != high)))
        while len(wrong):
            slots[wrong] = s = (slots[wrong] + 1) & self._mask
            found[wrong] = n = self._number[s]
            wrong = wrong[(n >= 0) & ((self._low[s] != low[wrong]) | (self._high[s] != high[wrong]))]
        return found

    def add(self, low: np.ndarray, high: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Distinct new entries, numbered on from the last; ``ids`` holds theirs one after the other."""
        first, slots = len(self), len(self._number)
        self.counts = np.concatenate([self.counts, counts])
        self.starts = np.concatenate([self.starts, self._used + np.cumsum(counts) - counts])
        if self._used + len(ids) > len(self._ids):
            self._ids = np.concatenate([self.ids, np.empty(self._used + 2 * len(ids), np.int32)])
        self._ids[self._used : self._used + len(ids)] = ids
        self._used += len(ids)
        number = np.arange(first, len(self), dtype=np.int32)
        if 2 * len(self) > slots:
            while 2 * len(self) > slots:
                slots *= 2
            full = self._number >= 0
            low, high = np.concatenate([self._low[full], low]), np.concatenate([self._high[full], high])
            number = np.concatenate([self._number[full], number])
            self._shift, self._mask = np.uint64(65 - slots.bit_length()), slots - 1
            self._low, self._high = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
            self._number = np.full(slots, -1, np.int32)
        at, todo = self._slot(low, high), np.arange(len(low))
        while len(todo):  # all entries still without a slot try the next one together
            free = todo[self._number[at[todo]] < 0]
            self._number[at[free]] = number[free]  # of several for one slot the last stays
            placed = free[self._number[at[free]] == number[free]]
            self._low[at[placed]], self._high[at[placed]] = low[placed], high[placed]
            left = np.ones(len(low), bool)
            left[placed] = False
            todo = todo[left[todo]]
            at[todo] = (at[todo] + 1) & self._mask


class WordBpe:
    """Ids of words by one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.library = Tokenizer.from_file(path)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        suffix = model["end_of_word_suffix"]
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.specials = [t["content"] for t in spec["added_tokens"]]
        symbols = _byte_symbols()
        self.inner = np.array([self.vocabulary[s] for s in symbols], dtype=np.int32)
        self.last = np.array([self.vocabulary[s + suffix] for s in symbols], dtype=np.int32)
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        v = self.vocabulary
        self.merger = PairMerger((v[a], v[b], rank, v[a + b]) for rank, (a, b) in enumerate(merges))
        self.suffix, self.symbols = suffix, symbols
        self._cache: BoundedCache = BoundedCache(CACHED_WORDS)
        self._pieces = PieceTable()
        self._known_pattern = self.pattern.pattern == _PATTERN
        self._of_code = np.array([_class(chr(c)) for c in range(_CODES)], dtype=np.uint8)
        self._of_byte = np.concatenate([self._of_code[:128], np.full(128, _ODD, np.uint8)])

    def words(self, text: str) -> list[str]:
        """The words between white space, in lower case already unless that could change the result."""
        low = text.lower()
        if "Σ" not in text and not any(s in low for s in self.specials):
            text = low  # else: a sigma depends on its place, special tokens on the case as written
        if _SEPARATORS.search(text):
            return [w for w in _WHITE.split(text) if w]
        return text.split()

    def plain(self, word: str) -> bool:
        return _PLAIN.fullmatch(word) is not None and not any(s in word for s in self.specials)

    def pieces(self, word: str) -> list[str]:
        """The pre-tokens of a plain word."""
        word = word.lower()
        return [word] if word.isalpha() else self.pattern.findall(word)

    def merge(self, pieces: list[str]) -> list[list[int]]:
        """The ids of pre-tokens, merged together."""
        raw = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
        every = np.frombuffer(b"".join(raw), dtype=np.uint8)
        ids = self.inner[every]
        ends = np.cumsum(lengths)[lengths > 0] - 1
        ids[ends] = self.last[every[ends]]
        return self.merger.merge_all(ids, lengths)

    def learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not in the cache yet."""
        plain = [w for w in words if self.plain(w)]
        pieces = [self.pieces(w) for w in plain]
        merged = iter(self.merge([p for own in pieces for p in own]))
        ids = {w: list(chain.from_iterable(islice(merged, len(own)))) for w, own in zip(plain, pieces)}
        if others := [w for w in words if w not in ids]:
            ids.update(zip(others, (e.ids for e in self.library.encode_batch(others, add_special_tokens=False))))
        return {w: struct.pack(f"<{len(i)}I", *i) for w, i in ids.items()}

    def encode_words(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, word by word."""
        split = [self.words(t) for t in texts]
        found = [list(map(self._cache.get, words)) for words in split]
        missing = {w for words, ids in zip(split, found) if None in ids for w, i in zip(words, ids) if i is None}
        if missing:
            learned = self.learn(list(missing))
            for words, ids in zip(split, found):
                if None in ids:
                    ids[:] = [learned[w] if i is None else i for w, i in zip(words, ids)]
            self._cache.make_room()
            self._cache.update(learned)
        return list(map(b"".join, found))

    def units(self, raw: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of what is looked up in ``size`` bytes of lower-case text, and which of it is odd.

        Plain words come as their pre-tokens, others whole.  At least three zeros follow the text.
        """
        kind = self._of_byte[raw]
        lead = np.flatnonzero((raw >= 0xC2) & (raw < 0xC0 + (_CODES >> 6)))
        kind[lead] = kind[lead + 1] = self._of_code[(raw[lead].astype(np.int64) & 31) << 6 | raw[lead + 1] & 63]
        kind[size:] = _WHITE_SPACE
        white = kind == _WHITE_SPACE
        start = ~white
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        start &= (raw & 0xC0) != 0x80
        mark = np.flatnonzero(raw == ord("'"))
        mark = mark[start[mark]]
        one, two = raw[mark + 1], raw[mark + 2]
        s, t, m, d, r, v, l, e = b"stmdrvle"  # noqa: E741
        short = (one == s) | (one == t) | (one == m) | (one == d)
        long = ((one == r) | (one == v)) & (two == e) | (one == l) & (two == l)
        mark, after = mark[short | long], (mark + 2 + long)[short | long]
        start[mark + 1] = False
        start[after[kind[after] == _LETTER]] = True
        odd = np.flatnonzero(kind == _ODD)
        if len(odd):
            spaces = np.concatenate([[-1], np.flatnonzero(white)])
            before = np.unique(np.searchsorted(spaces, odd)) - 1
            odd, ends = spaces[before] + 1, spaces[before + 1]
            inside = np.zeros(len(raw) + 1, dtype=np.int32)
            inside[odd] += 1
            inside[ends] -= 1
            start &= np.cumsum(inside[:-1]) == 0
            start[odd] = True
        border = start.copy()
        border[1:] |= white[1:] & ~white[:-1]
        border = np.flatnonzero(border)
        unit = np.flatnonzero(start[border])
        starts, ends = border[unit], border[unit + 1]  # white space follows the text
        is_odd = np.zeros(len(raw), dtype=bool)
        is_odd[odd] = True
        return starts, ends, is_odd[starts]

    def _learn_pieces(self, raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Puts short pre-tokens into the table; returns their numbers there."""
        order = np.lexsort((high, low))
        changes = np.ones(len(order), dtype=bool)
        changes[1:] = (np.diff(low[order]) != 0) | (np.diff(high[order]) != 0)
        new = order[changes]
        sizes = lengths[new]
        ends = np.cumsum(sizes)
        every = raw[np.repeat(starts[new] - ends + sizes, sizes) + np.arange(int(sizes.sum()))]
        ids = self.inner[every]
        ids[ends - 1] = self.last[every[ends - 1]]
        numbers = np.empty(len(order), dtype=np.int64)
        numbers[order] = len(self._pieces) + np.cumsum(changes) - 1
        self._pieces.add(low[new], high[new], *self.merger.merge_flat(ids, sizes))
        return numbers

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit numbers."""
        if not self._known_pattern:
            return self.encode_words(texts)
        lowered = [t.lower() for t in texts]
        # a sigma depends on its place, special tokens on the case as written
        apart = [i for i, t in enumerate(lowered) if "Σ" in texts[i] or any(s in t for s in self.specials)]
        for i in apart:
            lowered[i] = ""
        encoded = [t.encode() for t in lowered]
        joined = b"\n".join(encoded)
        padded = joined + bytes(SHORT)
        raw = np.frombuffer(padded, dtype=np.uint8)
        starts, ends, odd = self.units(raw, len(joined))
        lengths = ends - starts
        slow = odd | (lengths > SHORT)

        eights = np.ndarray(len(raw) - 7, dtype="<u8", buffer=padded, strides=(1,))
        low = eights[starts] & _BYTES[np.minimum(lengths, 8)]
        high = np.where(lengths > 8, eights[np.minimum(starts + 8, len(eights) - 1)], 0) & _BYTES[np.clip(lengths - 8, 0, 8)]
        if len(self._pieces) > CACHED_PIECES:
            self._pieces.clear()
        number = self._pieces.find(low, high)
        new = np.flatnonzero((number < 0) & ~slow)
        if len(new):
            number[new] = self._learn_pieces(raw, starts[new], lengths[new], low[new], high[new])

        alone = np.flatnonzero(slow)
        own = self.encode_words([padded[a:b].decode() for a, b in zip(starts[alone].tolist(), ends[alone].tolist())])
        number[alone] = 0
        table, n_units = self._pieces, len(number)
        counts = table.counts[number] if len(table) else np.zeros(n_units, np.int64)
        counts[alone] = [len(ids) // 4 for ids in own]
        places = np.concatenate([[0], np.cumsum(counts)])
        fast = np.flatnonzero(~slow)
        ids = np.empty(places[-1], dtype="<u4")
        if len(alone):
            for at, part in zip(places[alone].tolist(), own):
                ids[at : at + len(part) // 4] = np.frombuffer(part, dtype="<u4")
            to = np.repeat(places[fast] - (np.cumsum(counts[fast]) - counts[fast]), counts[fast]) + np.arange(int(counts[fast].sum()))
        else:
            to = slice(None)
        if len(fast):
            n = counts[fast]
            ids[to] = table.ids[np.repeat(table.starts[number[fast]] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]

        sizes = np.fromiter(map(len, encoded), dtype=np.int64, count=len(encoded))
        begins = np.concatenate([[0], np.cumsum(sizes + 1)])
        edges = (4 * places[np.searchsorted(starts, begins)]).tolist()
        every = ids.tobytes()
        out = [every[a:b] for a, b in zip(edges, edges[1:])]
        for i, own_ids in zip(apart, self.encode_words([texts[i] for i in apart])):
            out[i] = own_ids
        return out


def word_bpe(path: str) -> WordBpe:
    gc.set_threshold(200_000, 20, 50)  # lists of ids hold no cycles
    return only_model(WordBpe, path)
