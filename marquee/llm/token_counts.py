"""Token counts with a shortcut for words that are one token as a whole.

``whole_tokens`` proves, once per vocabulary and by the tokenizer itself, which
vocabulary strings encode alone as exactly one token.  A pre-token in that set
counts one without any merging; only the others are merged.  Words carry their
count into a bounded cache, so that a common word costs one look-up.

Inputs and results that need saying: a null or empty text has 0 bytes and 0
tokens; strings of special tokens inside a text count as the library counts
them, one token each; equal rows give equal results; an empty table gives no
rows; further columns are not looked at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.pair_merge import BoundedCache
from marquee.llm.texts import only_model, steps
from marquee.llm.word_bpe import CACHED_WORDS, WordBpe, word_bpe

LIMIT = 2048


def whole_tokens(bpe: WordBpe) -> frozenset[str]:
    """Pre-tokens that the tokenizer turns into one token, found by encoding every vocabulary string."""
    of_symbol = {s: b for b, s in enumerate(bpe.symbols)}
    strings = []
    for token in bpe.vocabulary:
        if token in bpe.specials or not token.endswith(bpe.suffix):
            continue
        try:
            string = bytes(of_symbol[c] for c in token.removesuffix(bpe.suffix)).decode()
        except (UnicodeDecodeError, KeyError):
            continue  # part of a character, never a pre-token of its own
        if bpe.plain(string) and bpe.words(string) == [string] and bpe.pieces(string) == [string]:
            strings.append(string)
    encoded = bpe.library.encode_batch(strings, add_special_tokens=False)
    return frozenset(s for s, e in zip(strings, encoded) if len(e.ids) == 1)


class TokenCounter:
    def __init__(self, path: str):
        self.bpe = word_bpe(path)
        self.whole = whole_tokens(self.bpe)
        self._cache: BoundedCache = BoundedCache(CACHED_WORDS)
        self._cache.update(dict.fromkeys(self.whole, 1))

    def _learn(self, words: list[str]) -> dict[str, int]:
        counts: dict[str, int] = {}
        rest: list[tuple[str, str]] = []  # (word, pre-token that has to be merged)
        others = []
        for word in words:
            if not self.bpe.plain(word):
                others.append(word)
                continue
            pieces = self.bpe.pieces(word)
            merging = [p for p in pieces if p not in self.whole]
            counts[word] = len(pieces) - len(merging)
            rest += [(word, p) for p in merging]
        for (word, _), ids in zip(rest, self.bpe.merge([p for _, p in rest])):
            counts[word] += len(ids)
        encoded = self.bpe.library.encode_batch(others, add_special_tokens=False)
        return counts | {w: len(e.ids) for w, e in zip(others, encoded)}

    def count(self, texts: list[str]) -> list[int]:
        split = [self.bpe.words(t) for t in texts]
        found = [list(map(self._cache.get, words)) for words in split]
        missing = {w for words, n in zip(split, found) if None in n for w, i in zip(words, n) if i is None}
        if not missing:
            return [sum(n) for n in found]
        learned = self._learn(list(missing))
        totals = [
            sum(n) if None not in n else sum(learned[w] if i is None else i for w, i in zip(words, n))
            for words, n in zip(split, found)
        ]
        if len(self._cache) + len(learned) > CACHED_WORDS:
            self._cache.clear()
            self._cache.update(dict.fromkeys(self.whole, 1))
        self._cache.update(learned)
        return totals


def token_counter(path: str) -> TokenCounter:
    return only_model(TokenCounter, path)


def token_counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of each row; ``path`` names the vocabulary on every executor."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        counter = token_counter(path)
        for batch in batches:
            for first, texts in steps(batch, text):
                counts = counter.count(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(first, len(texts)),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts], pa.bool_()),
                    ],
                    names=[key, "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
