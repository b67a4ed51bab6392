"""Spark's ``xxhash64`` of words, in numpy: for tasks that must know where Spark looks for a row."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEED = 42  # Spark's own
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p)
    for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)


def _turned(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def _round(lane: np.ndarray, word: np.ndarray) -> np.ndarray:
    return _turned(lane + word * _P2, 31) * _P1


def _of_length(rows: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Hashes of the rows of a byte matrix: words of one length, each with its own seed."""
    size, at = rows.shape[1], 0
    words = lambda low, high, kind: np.ascontiguousarray(rows[:, low:high]).view(kind).astype(np.uint64)
    if size >= 32:
        lanes = [seed + _P1 + _P2, seed + _P2, seed, seed - _P1]
        for at in range(0, size - 31, 32):
            lanes = [_round(lane, word) for lane, word in zip(lanes, words(at, at + 32, "<u8").T)]
        at += 32
        found = sum((_turned(lane, by) for lane, by in zip(lanes[1:], (7, 12, 18))), _turned(lanes[0], 1))
        for lane in lanes:
            found = (found ^ _round(np.zeros_like(lane), lane)) * _P1 + _P4
    else:
        found = seed + _P5
    found = found + np.uint64(size)
    for at in range(at, size - 7, 8):
        found = _turned(found ^ _round(np.zeros_like(found), words(at, at + 8, "<u8")[:, 0]), 27) * _P1 + _P4
    at = size & -8
    if size - at >= 4:
        found = _turned(found ^ (words(at, at + 4, "<u4")[:, 0] * _P1), 23) * _P2 + _P3
        at += 4
    for i in range(at, size):
        found = _turned(found ^ (rows[:, i].astype(np.uint64) * _P5), 11) * _P1
    found = (found ^ (found >> np.uint64(33))) * _P2
    found = (found ^ (found >> np.uint64(29))) * _P3
    return found ^ (found >> np.uint64(32))


def xxhash64(words: pa.Array, first: str | None = None) -> np.ndarray:
    """``F.xxhash64(first, word)`` of each word, as int64; without ``first``, ``F.xxhash64(word)``."""
    seed = np.uint64(SEED) if first is None else xxhash64(pa.array([first])).view(np.uint64)[0]
    offsets, data = utf8(words)
    sizes = np.diff(offsets)
    found = np.empty(len(words), dtype=np.uint64)
    for size in np.unique(sizes):
        here = np.flatnonzero(sizes == size)
        rows = data[offsets[here][:, None] + np.arange(size)]
        found[here] = _of_length(rows, np.full(len(here), seed, dtype=np.uint64))
    return found.view(np.int64)


def utf8(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The edges of the words in their bytes, and the bytes."""
    words = words.cast(pa.string())
    _, edges, data = words.buffers()
    offsets = np.frombuffer(edges, dtype=np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    held = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return offsets - offsets[0], held[offsets[0] : offsets[-1]]
