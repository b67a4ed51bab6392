"""Occurrences of words in the rows of an Arrow batch, by sorted codes instead of strings.

Used inside tasks: a batch's words become codes in code-point order, and what is
counted is found in one stable sort of the codes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STEP_WORDS = 1 << 20  # words that one step of a batch holds before the next begins


def steps(batch: pa.RecordBatch, columns: list[str]) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``STEP_WORDS`` words in its list columns, of one row at least."""
    if not batch.num_rows:
        return
    sizes = sum(row_sizes(batch.column(c)) for c in columns)
    part = (np.cumsum(sizes) - sizes) // STEP_WORDS
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for low, high in zip(edges, edges[1:]):
        yield batch.slice(low, high - low)


def row_sizes(lists: pa.ListArray) -> np.ndarray:
    return pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


@dataclass(frozen=True)
class Coded:
    """Words that are not null, in the order they stand: row, place in the row, code; ``words`` are sorted."""

    rows: np.ndarray
    places: np.ndarray
    codes: np.ndarray
    words: pa.Array


def coded(lists: pa.ListArray) -> Coded:
    sizes = row_sizes(lists)
    found = lists.flatten().dictionary_encode()
    order = pc.sort_indices(found.dictionary).to_numpy()
    rank = np.empty(len(order) + 1, dtype=np.int32)
    rank[order], rank[-1] = np.arange(len(order), dtype=np.int32), -1
    codes = rank[found.indices.fill_null(-1).to_numpy(zero_copy_only=False)]
    rows = np.repeat(np.arange(len(lists)), sizes)
    places = np.arange(len(codes)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    held = codes >= 0
    if not held.all():
        rows, places, codes = rows[held], places[held], codes[held]
    return Coded(rows, places, codes, found.dictionary.take(pa.array(order)))


@dataclass(frozen=True)
class Runs:
    """One run for each distinct (code, row), in that order: its first place in ``order``, and its length."""

    order: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray


def runs(rows: np.ndarray, codes: np.ndarray) -> Runs:
    """Runs of equal (code, row); ``rows`` ascend, so a stable sort by code keeps rows and places in order."""
    narrow = codes.astype(np.uint16) if len(codes) and codes.max() < 1 << 16 else codes  # radix sort
    order = np.argsort(narrow, kind="stable")
    c, r = codes[order], rows[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (c[1:] != c[:-1]) | (r[1:] != r[:-1])
    starts = np.flatnonzero(new)
    return Runs(order, starts, np.diff(np.append(starts, len(order))))
