"""Byte-pair merging of many distinct words at once.

``PairMerger`` holds the merge table of a vocabulary in an open-addressing hash
table of numpy arrays.  ``merge_all`` runs the merge rounds of thousands of words
together; only words longer than ``WIDE`` symbols take the heap, whose cost is
``n log n`` in the length of the word.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence

import numpy as np

WIDE = 48  # symbols up to which words are merged as rows of a matrix
_NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class PairMerger:
    """Merge table: a pair of symbol ids -> (rank, id of the merged symbol)."""

    def __init__(self, pairs: Iterable[tuple[int, int, int, int]]):
        table = np.array(list(pairs), dtype=np.int64).reshape(-1, 4)
        assert not len(table) or table[:, :2].max() < 1 << 17 and table[:, 2].max() < 1 << 29
        keys = (table[:, 0] << 17) | table[:, 1]
        bits = max(4, int(np.ceil(np.log2(2 * len(keys) + 1))))
        self._shift = np.uint64(64 - bits)
        self._mask = (1 << bits) - 1
        self._packed = np.full(1 << bits, -1, dtype=np.int64)  # pair above, rank below
        self._merged = np.zeros(table[:, 2].max(initial=0) + 1, dtype=np.int32)
        self._merged[table[:, 2]] = table[:, 3]
        slots = self._slot(keys)
        todo, self._probes = np.arange(len(keys)), 0
        while len(todo):  # all pairs still without a slot try the next one together
            free = self._packed[slots[todo]] < 0
            first = np.unique(slots[todo][free], return_index=True)[1]
            placed = todo[free][first]
            self._packed[slots[placed]] = (keys[placed] << 29) | table[placed, 2]
            todo = np.setdiff1d(todo, placed)
            slots[todo] = (slots[todo] + 1) & self._mask
            self._probes += 1
        self._by_pair: dict[int, tuple[int, int]] | None = None
        self._table = table

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> self._shift).astype(np.int64)

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``_NONE`` where it does not merge."""
        keys = (left.astype(np.int64) << 17) | right
        slots = self._slot(keys)
        found = self._packed[slots]
        wrong = np.flatnonzero(((found >> 29) != keys) & (found >= 0))
        if len(wrong):
            flat, k, s = found.ravel(), keys.ravel(), slots.ravel()
            while len(wrong):
                s[wrong] = (s[wrong] + 1) & self._mask
                flat[wrong] = self._packed[s[wrong]]
                wrong = wrong[((flat[wrong] >> 29) != k[wrong]) & (flat[wrong] >= 0)]
            found = flat.reshape(keys.shape)
        return np.where(found >= 0, found & ((1 << 29) - 1), _NONE).astype(np.int32)

    def merge_all(self, symbols: np.ndarray, lengths: np.ndarray) -> list[list[int]]:
        """The merged ids of each word; ``symbols`` holds the words' initial ids one after the other."""
        out: list[list[int]] = [[]] * len(lengths)
        for which, ids in self._blocks(symbols, lengths):
            for i, row in zip(which.tolist(), ids.tolist()):
                out[i] = row
        return out

    def merge_flat(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The merged ids of all words one after the other, and how many each word has."""
        counts = np.zeros(len(lengths), dtype=np.int64)
        blocks = list(self._blocks(symbols, lengths))
        for which, ids in blocks:
            counts[which] = ids.shape[1]
        starts = np.cumsum(counts) - counts
        out = np.empty(int(counts.sum()), dtype=np.int32)
        for which, ids in blocks:
            out[starts[which][:, None] + np.arange(ids.shape[1])] = ids
        return out, counts

    def _blocks(self, symbols: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(words, their merged ids as rows of one width), until every word that is not empty has come."""
        ends = np.cumsum(lengths)
        starts = ends - lengths
        for i in np.flatnonzero(lengths > WIDE).tolist():
            yield np.array([i]), np.array([self._merge_long(symbols[starts[i] : ends[i]].tolist())], dtype=np.int32)
        for length in np.unique(lengths[(lengths > 0) & (lengths <= WIDE)]).tolist():
            members = np.flatnonzero(lengths == length)
            rows = symbols[starts[members][:, None] + np.arange(length)]
            if length == 1:
                yield members, rows
                continue
            for which, ids in self._merge_rows(rows):
                yield members[which], ids

    def _merge_rows(self, ids: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of one length; every round merges the leftmost best pair of each."""
        which = np.arange(len(ids))
        rank = self._look(ids[:, :-1], ids[:, 1:])
        while True:
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(ids)), at]
            done = best == _NONE
            if done.any():
                yield which[done], ids[done]
                live = ~done
                ids, rank, which, at, best = ids[live], rank[live], which[live], at[live], best[live]
            if not len(ids):
                return
            rows, width = np.arange(len(ids)), ids.shape[1]
            ids[rows, at] = self._merged[best]
            keep = np.ones(ids.shape, dtype=bool)
            keep[rows, at + 1] = False
            ids = ids[keep].reshape(len(ids), width - 1)
            if width == 2:
                yield which, ids
                return
            keep = np.ones(rank.shape, dtype=bool)
            keep[rows, at] = False
            rank = rank[keep].reshape(len(ids), width - 2)
            for side in (at - 1, at):  # the pairs that hold the new symbol
                r = rows[(side >= 0) & (side < width - 2)]
                c = side[r]
                rank[r, c] = self._look(ids[r, c], ids[r, c + 1])

    def _merge_long(self, word: Sequence[int]) -> list[int]:
        if self._by_pair is None:
            self._by_pair = {(a << 32) | b: (rank, new) for a, b, rank, new in self._table.tolist()}
        pairs, ids = self._by_pair, list(word)
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(ids) and (found := pairs.get((ids[i] << 32) | ids[after[i]])):
                heapq.heappush(heap, (found[0], i, ids[i], ids[after[i]], found[1]))

        for i in range(len(ids)):
            offer(i)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]


class BoundedCache(dict):
    """A dict that forgets everything when ``limit`` entries are in; results never depend on it."""

    def __init__(self, limit: int):
        super().__init__()
        self._limit = limit

    def make_room(self) -> None:
        if len(self) > self._limit:
            self.clear()
