"""Jaccard join of word n-grams over an R-tree of count vectors.

A document is the set of its distinct shingles.  Shingles are hashed to
``GROUPS`` groups; the counts of the groups are a point, and the sum of the
coordinate minima of two points is never below the size of the intersection.
That bounds pairs of points and, through the upper corners of rectangles, pairs
of nodes.

In so many dimensions the rectangles of unrelated texts all overlap, so one tree
over everything would try every pair of nodes.  The points are therefore dealt to
families first.  Sets that are similar enough differ by ``d`` shingles at most, by
their sizes; hashed to ``d + 1`` groups, or some more, they agree in the whole
content of one.  Shared passages hardly make a group agree, near copies do.  Sizes
are dealt to levels that overlap, with groups for the largest ``d`` of each.  A
level with ``e`` further groups leaves ``1 + e`` that agree, so a set with up to
``e`` empty groups need not be found by these.  Sets that agree meet in a cell,
pairs that may be similar are joined, and families are what is connected.  For that a
set has the parities of its counts in ``BITS`` groups: a shingle that only one of two
sets has changes one of them, so they differ in as many at least as parities do.
Joining too much is safe, losing a pair is not, so a cell too large for pairs is
joined whole.
Families, sizes and counts are the sort order in which the points are packed
into leaf blocks.  Blocks meet themselves and their neighbour first; what is then
not in its family's largest component, in chunks of the same order, meets the blocks
of the family whose rectangle's upper corner and least size leave a link possible.
Inside a meeting small nodes are tried against each other, then points, then
finer counts of the points that are left, in so many groups that one holds about
four shingles (in 32 groups two long texts look alike); only what survives that
gets its set and is verified on it.

Equal sets are one point from the start, with a number of their own, so texts that
share an id are nodes apart; a component is named by its smallest id at the end.
Inputs and results that need saying: a null text, one without words, or a null id
has 0 shingles (null id: its own count) and is linked with nothing; with fewer
words than ``size`` the whole sequence is one shingle; equal rows and equal ids are
rows of their own; an empty table gives no rows; further columns are not looked at.
Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.components import connected_components
from marquee.llm.texts import forget_model, steps
from marquee.session import materialise, release

GROUPS = 32  # dimensions of the points
BITS = 1024  # groups whose counts' parities a cell compares
STEP = 1.25  # from the differing shingles of a level to those of the next
CELL = 512  # members up to which a cell looks at pairs
BLOCK = 512  # points in a leaf block
NODE = 16  # points in the smallest nodes
FINE_ROWS = 256  # points whose finer counts are compared with one at once
TEXTS = 256  # texts in a batch, so that workers stay small
COLUMNS = 4096  # shared shingles that one product takes
MARKS = 1 << 22  # hashed marks by which a pass over the texts knows the documents it needs, half a megabyte


_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F))


def _mixed(h: np.ndarray, by: np.uint64) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * by
    return h ^ (h >> np.uint64(29))


def _word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words of each text.

    A word's hash is the sum of a random-looking number for each of its bytes at
    its place, so all words of a batch are summed at once.
    """
    encoded = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join(encoded).lower() + b"\n", dtype=np.uint8)  # bytes: only A-Z become lower
    white = _WHITE[raw]
    first = ~white
    first[1:] &= white[:-1]
    starts = np.flatnonzero(first)
    ends = np.cumsum(np.fromiter(map(len, encoded), dtype=np.int64, count=len(texts)) + 1)
    words = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), words
    place = np.arange(len(raw))
    place[starts[0] :] -= np.repeat(starts, np.diff(starts, append=len(raw)))
    value = _mixed(raw.astype(np.uint64) + place.astype(np.uint64) * np.uint64(257) + _C, _A)
    value[white] = 0
    return _mixed(np.add.reduceat(value, starts), _B), words


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """The sorted hashes of the distinct shingles of each text."""
    if not texts:
        return []
    ids, words = _word_hashes(texts)

    def shingles(ids: np.ndarray, width: int) -> np.ndarray:
        h = np.full(max(0, len(ids) - width + 1), width, dtype=np.uint64)
        for i in range(width):
            h = (h ^ (h >> np.uint64(29))) * _A + ids[i : len(ids) - width + 1 + i]
        return _mixed(h, _C)

    every = shingles(ids, size)
    out, at = [], 0
    for n in words.tolist():
        if n >= size:
            out.append(np.unique(every[at : at + n - size + 1]))
        else:  # the whole text is one shingle, if it has words
            out.append(shingles(ids[at : at + n], n) if n else np.zeros(0, dtype=np.uint64))
        at += n
    return out


def _spare(apart: int, n: float) -> int:
    """How many further groups a level gets: as many as its smallest sets, of ``n`` shingles, mostly have empty groups.

    With few shingles there may be no such number; then the one that comes closest.
    """
    best, least = 0, float("inf")
    for spare in range(apart + 2):
        groups = apart + 1 + spare
        empty = groups * (1 - 1 / groups) ** n
        missing = empty + 2 * empty**0.5 - 0.5 - spare
        if missing <= 0:
            return spare
        if missing < least:
            best, least = spare, missing
    return best


def _levels(num: int, den: int) -> Iterator[tuple[int, int]]:
    """(differing shingles at most, further groups) of each level, without end."""
    apart = 0
    while True:
        before, apart = apart, max(apart + 1, int(apart * STEP))
        yield apart, _spare(apart, (before + 1) * (den + num) / (den - num) / 2)


class Contents:
    """Keys of what a set has in its groups, at every level of sizes at which it can have a partner."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.made = _levels(num, den)
        self.apart, self.spare, self.edges = [], [], []

    def apart_at_most(self, both: int) -> int:
        """By how many shingles two similar sets of that many together can differ."""
        return both * (self.den - self.num) // (self.den + self.num)

    def level(self, apart: int) -> int:
        while not self.apart or self.apart[-1] < apart:
            most, spare = next(self.made)
            groups = most + 1 + spare
            self.apart.append(most)
            self.spare.append(spare)
            self.edges.append(np.array([(i << 64) // groups for i in range(1, groups)], dtype=np.uint64))
        return bisect_left(self.apart, apart)

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """``hashes`` are sorted, and a group is a range of them, so a group's content is a slice."""
        n = len(hashes)
        low = self.apart_at_most(n - (-self.num * n // self.den))
        high = self.apart_at_most(n + self.den * n // self.num)
        if not high:
            return np.zeros(0, dtype=np.int64)  # only equal sets are similar, and they are one point
        mixed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(hashes, _B), dtype=np.uint64)])
        out = []
        for level in range(self.level(max(low, 1)), self.level(high) + 1):
            cut = np.concatenate([[0], np.searchsorted(hashes, self.edges[level]), [n]])
            group = np.arange(len(cut) - 1, dtype=np.uint64)
            key = _mixed(mixed[cut[1:]] - mixed[cut[:-1]] + (group + np.uint64(level << 32)) * _C, _A)
            filled = cut[1:] > cut[:-1]
            out.append(key[filled] if len(filled) - np.count_nonzero(filled) <= self.spare[level] else key)
        return np.concatenate(out).view(np.int64)


def _points(key: str, text: str, size: int, num: int, den: int):
    def work(batches):
        forget_model()
        contents = Contents(num, den)
        for batch in batches:
            for first, texts in steps(batch, text):
                sizes, digests, counts, fine, odd, keys = [], [], [], [], [], []
                stamps = [hashlib.md5(t.encode()).digest() for t in texts]
                for hashes in shingle_sets(texts, size):
                    n = len(hashes)
                    sizes.append(n)
                    digests.append(hashlib.md5(hashes.tobytes()).digest())
                    finer = _fine(hashes)
                    counts.append(_folded(finer, GROUPS).astype("<i4").tobytes())
                    fine.append(finer.astype("<u2").tobytes())
                    odd.append(_odd(hashes).tobytes())
                    keys.append(contents.keys(hashes) if n else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(first, len(texts)).cast(pa.int64()), pa.array(sizes, pa.int64()),
                        pa.array(stamps, pa.binary()), pa.array(digests, pa.binary()), pa.array(counts, pa.binary()), pa.array(fine, pa.binary()), pa.array(odd, pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum([len(k) for k in keys])]), pa.int32()),
                            pa.array(np.concatenate([np.zeros(0, np.int64), *keys])),
                        ),
                    ],
                    names=["id", "n", "stamp", "digest", "counts", "fine", "odd", "keys"],
                )

    return work


def _fine(hashes: np.ndarray) -> np.ndarray:
    """Counts in so many groups, a power of two, that one holds about four shingles."""
    groups = max(GROUPS, 1 << max(0, len(hashes) // 4).bit_length())
    return np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups)


def _odd(hashes: np.ndarray) -> np.ndarray:
    """In which of ``BITS`` groups the count is odd."""
    return np.packbits(np.bincount((hashes >> np.uint64(40) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) % 2 == 1)


def _few_apart(apart: np.ndarray, both: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether sets that differ by so many shingles at least, and have ``both`` together, can be similar."""
    return apart * (num + den) <= both * (den - num)


def _folded(fine: np.ndarray, groups: int) -> np.ndarray:
    """The same counts in fewer groups."""
    return fine.reshape(-1, groups).sum(axis=0)


def _overlap(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sums of coordinate minima of all pairs of two lists of points."""
    if len(a) * len(b) <= 4096:
        return np.minimum(a[:, None, :], b[None, :, :]).sum(axis=2, dtype=np.int64)
    total = np.zeros((len(a), len(b)), dtype=np.int64)
    for g in range(a.shape[1]):
        total += np.minimum(a[:, g][:, None], b[:, g][None, :])
    return total


def _enough(overlap: np.ndarray, a: np.ndarray, b: np.ndarray, num: int, den: int) -> np.ndarray:
    """Whether an intersection of that size reaches the threshold for sets of sizes a and b."""
    return overlap * (num + den) >= num * (a[:, None] + b[None, :])


def _groups_of(batches, columns: list[str]):
    """Runs of rows with equal first two columns, as lists of tuples, across batches."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[batch.column(c).to_pylist() for c in columns]):
            if row[:2] != key:
                if rows:
                    yield rows
                key, rows = row[:2], []
            rows.append(row)
    if rows:
        yield rows


def _edge_batch(left, right) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _spanned(near: np.ndarray) -> tuple[list[int], list[int]]:
    """Edges of a breadth-first tree of each component of a symmetric matrix."""
    left, right, seen = [], [], np.zeros(len(near), dtype=bool)
    for i in range(len(near)):
        if not seen[i]:
            seen[i], todo = True, [i]
            while todo:
                at = todo.pop()
                new = np.flatnonzero(near[at] & ~seen).tolist()
                seen[new] = True
                left += [at] * len(new)
                right += new
                todo += new
    return left, right


def _runs(batches):
    """Of sorted slots those whose key is not alone.

    A run of up to ``CELL`` is given as it is.  Of a longer one, and of the first and last of a
    part, which may go on in the next part, each is given with the run's first as ``centre``; of
    the first and last also the part.
    """
    forget_model()
    part, held, done = TaskContext.get().partitionId(), None, False

    def given(keys, reps, border: bool):
        """Rows of whole runs; ``border``: of a run at the border of the part."""
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(starts, append=len(keys))
        long, members = np.repeat((sizes > CELL) | border, sizes), np.repeat(sizes, sizes)
        keep = (members > 1) | border
        centre = np.repeat(reps[starts], sizes)
        return pa.RecordBatch.from_arrays(
            [pa.array(keys[keep]), pa.array(reps[keep]), pa.array(np.full(keep.sum(), part, np.int32), mask=np.full(keep.sum(), not border)),
             pa.array(centre[keep], mask=~long[keep])],
            names=["key", "rep", "part", "centre"],
        )

    for batch in batches:
        now = [batch.column("key").to_numpy(), batch.column("rep").to_numpy()]
        held = now if held is None else [np.concatenate(pair) for pair in zip(held, now)]
        if not len(held[0]):
            continue
        if not done:  # the first run
            own = held[0] == held[0][0]
            if own.all():
                if len(own) > CELL:  # what is given stays connected to the first
                    yield given(*held, True)
                    held = [c[:1] for c in held]
                continue
            yield given(*[c[own] for c in held], True)
            held, done = [c[~own] for c in held], True
        last = held[0] == held[0][-1]
        if not last.all():
            yield given(*[c[~last] for c in held], False)
            held = [c[last] for c in held]
        elif len(last) > 2 * CELL:
            yield given(*held, False)
            held = [c[: CELL + 1] for c in held]  # so that it is a long run to its end
    if held is not None and len(held[0]):
        yield given(*held, True)


def _cells(num: int, den: int):
    """Edges that span the pairs of each cell with a bound high enough."""

    def differing(odd: np.ndarray) -> np.ndarray:
        total = np.zeros((len(odd), len(odd)), dtype=np.int64)
        for word in odd.T:
            total += np.bitwise_count(word[:, None] ^ word[None, :])
        return total

    def joined(keys: np.ndarray, reps: np.ndarray, n: np.ndarray, odd: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
        sizes = np.diff(starts, append=len(keys))
        left, right = [], []
        for size in np.unique(sizes[sizes > 1]).tolist():
            here = starts[sizes == size]
            if size <= 8:  # all pairs of all cells of one size at once
                for i in range(size):
                    for j in range(i):
                        a, b = here + i, here + j
                        good = _few_apart(np.bitwise_count(odd[a] ^ odd[b]).sum(axis=1, dtype=np.int64), n[a] + n[b], num, den)
                        left.append(a[good])
                        right.append(b[good])
            else:
                for at in here.tolist():
                    own = slice(at, at + size)
                    a, b = _spanned(_few_apart(differing(odd[own]), n[own][:, None] + n[own][None, :], num, den))
                    left.append(np.array(a, dtype=np.int64) + at)
                    right.append(np.array(b, dtype=np.int64) + at)
        none = np.zeros(0, dtype=np.int64)
        return _edge_batch(reps[np.concatenate([none, *left])], reps[np.concatenate([none, *right])])

    def work(batches):
        forget_model()
        held = None
        for batch in batches:
            now = [
                batch.column("key").to_numpy(), batch.column("rep").to_numpy(), batch.column("n").to_numpy(),
                np.frombuffer(b"".join(batch.column("odd").to_pylist()), dtype=np.uint64).reshape(-1, BITS // 64),
            ]
            held = now if held is None else [np.concatenate(pair) for pair in zip(held, now)]
            if not len(held[0]):
                continue
            last = int(np.flatnonzero(held[0] != held[0][-1])[-1]) + 1 if held[0][0] != held[0][-1] else 0
            if last:  # the last cell may go on in the next batch
                yield joined(*[c[:last] for c in held])
                held = [c[last:] for c in held]
        if held is not None and len(held[0]):
            yield joined(*held)

    return work


def _surviving(points: np.ndarray, n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Pairs of points that the tree cannot rule out: first by the corners of its nodes, then by the points."""
    nodes = [slice(i, i + NODE) for i in range(0, len(n), NODE)]
    corner = np.stack([points[x].max(axis=0) for x in nodes])
    least = np.array([n[x].min() for x in nodes])
    near = np.zeros((len(n), len(n)), dtype=bool)
    for a, b in zip(*np.nonzero(np.triu(_enough(_overlap(corner, corner), least, least, num, den)))):
        x, y = nodes[a], nodes[b]
        near[x, y] = _enough(_overlap(points[x], points[y]), n[x], n[y], num, den)
        near[y, x] = near[x, y].T
    np.fill_diagonal(near, False)
    return near


def _places(shared: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Where the members of a set stand among the shared ones."""
    if not len(shared):
        return np.zeros(0, dtype=np.int64)
    place = np.minimum(np.searchsorted(shared, own), len(shared) - 1)
    return place[shared[place] == own]


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets: products of their incidence with what two or more hold."""
    every = np.concatenate(sets)
    every.sort()
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    del every
    held = [_places(shared, s) for s in sets]
    row, column = np.repeat(np.arange(len(sets)), [len(h) for h in held]), np.concatenate(held)
    total = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for first in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        here = (column >= first) & (column < first + COLUMNS)
        incidence = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        incidence[row[here], column[here] - first] = 1
        total += (incidence @ incidence.T).astype(np.int64)
    return total


def _thinned(near: np.ndarray, fine: list[bytes], n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Those of the pairs that the finer counts leave; of two points the finer one is folded to the groups of the other."""
    points = [np.frombuffer(f, dtype="<u2") for f in fine]
    groups = np.array([len(p) for p in points])
    out = np.zeros_like(near)
    for width in np.unique(groups[near.any(axis=1)]).tolist():
        own = groups == width
        wider = np.flatnonzero((groups >= width) & near[own].any(axis=0) | own)
        place = np.full(len(n), -1)
        place[wider] = np.arange(len(wider))
        folded = np.stack([_folded(points[i], width) if groups[i] > width else points[i] for i in wider]).astype(np.uint32)
        for i in np.flatnonzero(own).tolist():
            other = np.flatnonzero(near[i] & (groups >= width))
            for first in range(0, len(other), FINE_ROWS):
                some = other[first : first + FINE_ROWS]
                overlap = np.minimum(folded[place[i]], folded[place[some]]).sum(axis=1, dtype=np.int64)
                good = some[overlap * (num + den) >= num * (n[i] + n[some])]
                out[i, good] = out[good, i] = True
    return out


def _candidates(counts, fine, n, label, side, num: int, den: int, cross: bool) -> np.ndarray:
    """Pairs of points of a meeting that are to be compared and not ruled out by their counts, the finer ones too if given."""
    n, label, side = np.array(n), np.array(label), np.array(side)
    near = _surviving(np.stack([np.frombuffer(c, dtype="<i4") for c in counts]), n, num, den)
    sides = side[:, None] + side[None, :]
    near &= ((sides == 1) & (label[:, None] != label[None, :])) if cross else sides < 2
    return near if fine is None else _thinned(near, fine, n, num, den)


def _family_links(rows: list[tuple], num: int, den: int, cross: bool) -> tuple[list[int], list[int]]:
    """Edges that span the links among points of one family that meet.

    Points of side 1 are not compared with each other; ``cross``: only with side 0, and only other labels.
    """
    _, _, reps, n, counts, label, side, tokens = zip(*rows)
    n = np.array(n)
    near = _candidates(counts, None, n, label, side, num, den, cross)
    some = np.flatnonzero(near.any(axis=1))
    if not len(some):
        return [], []
    common = _common([np.frombuffer(tokens[i], dtype=np.uint64) for i in some])
    linked = near[np.ix_(some, some)] & _enough(common, n[some], n[some], num, den)
    left, right = _spanned(linked)
    return [reps[some[i]] for i in left], [reps[some[i]] for i in right]


def _with_sets(rows: DataFrame, tokens: DataFrame) -> DataFrame:
    """``rows`` with the set of each; of documents with equal ids only the one the point is of."""
    return rows.join(_parted(tokens, rows, "digest")[0], ["id", "digest"])


_BOUNDED = {"meeting": "string", "family": "bigint", "rep": "bigint", "id": "bigint", "digest": "binary", "n": "bigint", "counts": "binary",
            "label": "bigint", "side": "int"}


def _bounded(rows: DataFrame, num: int, den: int, cross: bool, name: str) -> DataFrame:
    """The points of each meeting that have another one there which the counts cannot rule out."""
    columns_of = [*_BOUNDED, "fine"]
    at = columns_of.index

    def work(batches):
        forget_model()
        for group in _groups_of(batches, columns_of):
            if len(group) > 1:
                columns = list(zip(*group))
                near = _candidates(*[columns[at(c)] for c in ("counts", "fine", "n", "label", "side")], num, den, cross)
                some = np.flatnonzero(near.any(axis=1)).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c[i] for i in some], pa.type_for_alias(_ARROW[k])) for c, k in zip(columns, _BOUNDED.values())], names=list(_BOUNDED)
                )

    dealt = rows.select(*columns_of).repartition("meeting").sortWithinPartitions("meeting", "family", "n", "rep")
    return _few_at_a_time(dealt.mapInArrow(work, ", ".join(f"{c} {t}" for c, t in _BOUNDED.items())), 1024, name)


def _few_at_a_time(result: DataFrame, rows: int, name: str) -> DataFrame:
    """Stores what Python workers make of wide rows, so many of which travel in a batch."""
    conf, setting = result.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(setting)
    conf.set(setting, str(rows))
    try:
        return materialise(result, name)
    finally:
        conf.set(setting, before)


_ARROW = {"string": "string", "bigint": "int64", "binary": "binary", "int": "int32"}


def _corners(keys: list[str], corner_name: str, least_name: str, most_name: str):
    """The upper corner, the least and the greatest size of a group of points."""

    def work(table: pa.Table) -> pa.Table:
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), dtype="<i4").reshape(-1, GROUPS)
        corner, n = counts.max(axis=0).tobytes(), table.column("n").to_numpy()
        sizes = {least_name: pa.array([n.min()], pa.int64()), most_name: pa.array([n.max()], pa.int64())}
        return pa.table({k: table.column(k).slice(0, 1) for k in keys} | {corner_name: pa.array([corner], pa.binary())} | sizes)

    return work


def _within_reach(num: int, den: int):
    """Pairs of chunk and block in which two points may link."""

    def work(batches):
        forget_model()
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<i4").reshape(-1, GROUPS) for c in ("corner", "other_corner"))
            least, most, other_least, other_most = (batch.column(c).to_numpy() for c in ("least", "most", "other_least", "other_most"))
            good = np.minimum(a, b).sum(axis=1, dtype=np.int64) * (num + den) >= num * (least + other_least)
            good &= (num * least <= den * other_most) & (num * other_least <= den * most)  # sets of too different sizes cannot link
            yield batch.filter(pa.array(good, pa.bool_())).select(["family", "chunk", "part", "block", "least", "most", "other_least", "other_most"])

    return work


_MEETING = ["meeting", "family", "rep", "n", "counts", "label", "side", "tokens"]


def _meet(rows: DataFrame, num: int, den: int, cross: bool, name: str) -> DataFrame:
    def work(batches):
        forget_model()
        for group in _groups_of(batches, _MEETING):
            if len(group) > 1:
                left, right = _family_links(group, num, den, cross)
                yield _edge_batch(left, right)

    dealt = rows.select(*_MEETING).repartition("meeting").sortWithinPartitions("meeting", "family", "n", "rep")
    return _few_at_a_time(dealt.mapInArrow(work, "a bigint, b bigint"), 128, name)


def _mark(*columns: str):
    return F.pmod(F.xxhash64(*columns), F.lit(MARKS)) + 1


def _marks(rows: DataFrame, *columns: str) -> DataFrame:
    """Which hashed marks the rows have, as bits: a row for each 32768 marks, so a table of bounded size."""
    parts = rows.groupBy(F.bitmap_bucket_number(_mark(*columns)).alias("mark part"))
    return parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position(_mark(*columns))).alias("mark bits"))


def _bitmap(ids: DataFrame, column: str) -> np.ndarray:
    out = np.zeros((MARKS // 32768, 4096), dtype=np.uint8)
    for row in _marks(ids, column).collect():
        out[row["mark part"] - 1] = np.frombuffer(row["mark bits"], dtype=np.uint8)
    return np.unpackbits(out.ravel(), bitorder="little").astype(bool)


def _parted(rows: DataFrame, some: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """The rows that may be like one of ``some`` in ``columns``, and those that are surely not; the latter need no shuffle.

    The marks come by a join: as a literal they would be spelled out wherever the driver keeps a plan's text.
    """
    marks = materialise(_marks(some, *columns), "jaccard-marks")
    marked = rows.join(F.broadcast(marks), F.bitmap_bucket_number(_mark(*columns)) == F.col("mark part"), "left")
    place = F.bitmap_bit_position(_mark(*columns))
    byte = F.conv(F.hex(F.substring("mark bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return tuple(marked.where(side).drop("mark part", "mark bits") for side in (bit, ~bit))


def _tokens(text: str, size: int, wanted: np.ndarray):
    def work(batches):
        forget_model()
        for batch in batches:
            batch = batch.filter(pa.array(wanted[batch.column("mark").to_numpy() - 1], pa.bool_()))
            for first, texts in steps(batch, text):
                raw = [s.tobytes() for s in shingle_sets(texts, size)]
                digests = [hashlib.md5(s).digest() for s in raw]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(first, len(texts)), pa.array(digests, pa.binary()), pa.array(raw, pa.binary())],
                    names=["id", "digest", "tokens"],
                )

    return work


def _components(docs: DataFrame, size: int, num: int, den: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(id, stamp of the text, n, digest of the set) of each row, and (digest, root, component_id) of each set."""
    docs = docs.select(key, text)

    schema = "id bigint, n bigint, stamp binary, digest binary, counts binary, fine binary, odd binary, keys array<bigint>"
    points = _few_at_a_time(docs.mapInArrow(_points(key, text, size, num, den), schema), TEXTS, "jaccard-points")
    signed = materialise(points.select("id", "n", "stamp", "digest"), "jaccard-signed")
    usable = points.where("n > 0 AND id IS NOT NULL")
    repeated = signed.where("n > 0 AND id IS NOT NULL").groupBy("digest").count().where("count > 1")
    columns = ["n", "counts", "fine", "odd", "keys"]
    copies, alone = _parted(usable, repeated, "digest")  # sets are wide, and most are unlike all others
    reps = copies.groupBy("digest").agg(F.min("id").alias("id"), *[F.first(c).alias(c) for c in columns])
    reps = reps.unionByName(alone.select("digest", "id", *columns))
    reps = materialise(reps.withColumn("rep", F.monotonically_increasing_id()), "jaccard-sets")  # ids may repeat, sets do not
    release(points)  # the keys are the bulk of it

    # Cells of sets with the same content of a group, and the families they make.
    slots = reps.select(F.explode("keys").alias("key"), "rep").repartitionByRange("key", "rep").sortWithinPartitions("key", "rep")
    met = materialise(slots.mapInArrow(_runs, "key bigint, rep bigint, part int, centre bigint"), "jaccard-slots")
    large = met.where("centre IS NOT NULL").select(F.col("rep").alias("a"), F.col("centre").alias("b"))
    ends = met.where("part IS NOT NULL").groupBy("part", "key").agg(F.min("rep").alias("rep"))  # up to two a part
    beside = F.lag("key").over(Window.orderBy("key", "part")) == F.col("key")
    ends = ends.select(beside.alias("same"), F.col("rep").alias("a"), F.lag("rep").over(Window.orderBy("key", "part")).alias("b"))
    large = large.unionByName(ends.where("same").select("a", "b"))
    small = met.where("centre IS NULL AND part IS NULL").select("key", "rep").join(reps.select("rep", "n", "odd"), "rep")
    small = small.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(_cells(num, den), "a bigint, b bigint")
    edges = materialise(large.unionByName(small), "jaccard-cells")
    families = connected_components(edges, "a", "b")
    families = materialise(families.select(F.col("node").alias("rep"), F.col("root").alias("family")), "jaccard-families")

    # Their order, in which leaf blocks are cut, and their sets.
    by = ["family", "n", "counts", "rep"]
    in_one = _parted(reps.select("rep", "id", "digest", "n", "counts", "fine"), families, "rep")[0]
    ranged = families.join(in_one, "rep").repartitionByRange(*by).sortWithinPartitions(*by)
    position = F.monotonically_increasing_id()
    ranged = ranged.withColumn("part", F.shiftright(position, 33).cast("long"))
    ranged = ranged.withColumn("block", F.floor(position.bitwiseAND((1 << 33) - 1) / BLOCK).cast("long"))
    ranged = materialise(ranged, "jaccard-blocks")
    source = docs.select(F.col(key).cast("long").alias("id"), text).where("id IS NOT NULL").withColumn("mark", _mark("id"))
    tokens = source.mapInArrow(_tokens(text, size, _bitmap(ranged, "id")), "id bigint, digest binary, tokens binary")
    tokens = _few_at_a_time(tokens, TEXTS, "jaccard-tokens")
    if not tokens.groupBy("id", "digest").count().where("count > 1").isEmpty():  # repeated rows
        tokens = materialise(tokens.dropDuplicates(["id", "digest"]), "jaccard-tokens-once")
    release(edges)

    # A block and its neighbour: the next in its part, or the first of the next part with rows.
    blocks = ranged.groupBy("part", "block").agg(F.max("family").alias("family"))
    ends = blocks.groupBy("part").agg(F.max("block").alias("last"))
    ends = ends.withColumn("after", F.lead("part").over(Window.orderBy("part")))  # a row for each part
    after = F.col("block") == F.col("last")
    meetings = blocks.join(ends, "part").select(
        F.concat_ws(":", "part", "block").alias("meeting"),
        "family",  # the only one that can go on in the next block
        F.when(after, F.col("after")).otherwise(F.col("part")).alias("part"),
        F.when(after, F.lit(0)).otherwise(F.col("block") + 1).cast("long").alias("block"),
    )
    own = ranged.withColumn("meeting", F.concat_ws(":", "part", "block")).withColumn("side", F.lit(0))
    next_to = ranged.join(meetings, ["part", "block", "family"]).withColumn("side", F.lit(1))
    first = own.unionByName(next_to).withColumn("label", F.col("rep"))
    first = _bounded(first, num, den, False, "jaccard-first-bounded")
    links = _meet(_with_sets(first, tokens), num, den, False, "jaccard-first")

    # What is not in its family's largest component meets the blocks of the family within reach.
    roots = connected_components(links, "a", "b").select(F.col("node").alias("rep"), F.col("root"))
    labelled = ranged.join(roots, "rep", "left").withColumn("label", F.coalesce("root", "rep")).drop("root")
    labelled = materialise(labelled.drop("counts", "fine", "id", "digest"), "jaccard-labels")
    per = labelled.groupBy("family", "label").agg(F.count("*").alias("m"))
    main = per.groupBy("family").agg(F.max_by("label", F.struct("m", "label")).alias("main"), (F.sum("m") - F.max("m")).alias("strays"))
    main = main.where("strays > 0")
    met = labelled.join(main, "family").select("family", "part", "block").distinct()
    wide = met.groupBy("family").agg(F.count("*").alias("m")).where("m > 2")  # up to two blocks have met entirely
    main = main.join(wide, "family").withColumn("run", F.ceil(F.col("m") / F.ceil(F.col("strays") / BLOCK)))  # blocks of a chunk
    strays = labelled.join(main, "family").where(F.col("label") != F.col("main"))
    strays = strays.select("rep", "family", "part", F.floor(F.col("block") / F.col("run")).alias("run"))
    pieces = strays.groupBy("family", "part", "run").agg(F.ceil(F.count("*") / BLOCK).alias("pieces"))
    piece = F.pmod(F.xxhash64("rep"), F.col("pieces"))
    strays = strays.join(pieces, ["family", "part", "run"]).select("rep", F.concat_ws(":", "part", "run", piece).alias("chunk"))
    full = ranged.join(main.select("family"), "family").join(labelled.select("rep", "label"), "rep")
    asking = materialise(full.join(strays, "rep").drop("part", "block"), "jaccard-strays")
    of_chunks = asking.select("family", "chunk", "n", "counts").groupBy("family", "chunk")
    of_chunks = of_chunks.applyInArrow(
        _corners(["family", "chunk"], "corner", "least", "most"), "family bigint, chunk string, corner binary, least bigint, most bigint"
    )
    of_blocks = full.select("family", "part", "block", "n", "counts").groupBy("family", "part", "block")
    of_blocks = of_blocks.applyInArrow(
        _corners(["family", "part", "block"], "other_corner", "other_least", "other_most"),
        "family bigint, part bigint, block bigint, other_corner binary, other_least bigint, other_most bigint",
    )
    sizes = "least bigint, most bigint, other_least bigint, other_most bigint"
    near = of_chunks.join(of_blocks, "family").mapInArrow(_within_reach(num, den), f"family bigint, chunk string, part bigint, block bigint, {sizes}")
    near = materialise(near, "jaccard-near")
    columns = ["family", "chunk", "part", "block", "rep", "id", "digest", "n", "counts", "fine", "label", "side"]
    fits = lambda least, most: (F.col("n") * den >= F.col(least) * num) & (F.col("n") * num <= F.col(most) * den)
    asking = asking.join(near, ["family", "chunk"]).where(fits("other_least", "other_most")).withColumn("side", F.lit(1))
    answering = full.join(near, ["family", "part", "block"]).where(fits("least", "most")).withColumn("side", F.lit(0))
    second = asking.select(*columns).unionByName(answering.select(*columns))
    second = second.withColumn("meeting", F.concat_ws("/", "family", "chunk", "part", "block"))
    second = _bounded(second, num, den, True, "jaccard-second-bounded")
    more = _meet(_with_sets(second, tokens), num, den, True, "jaccard-second")

    roots = connected_components(links.unionByName(more), "a", "b")
    named = roots.join(reps.select(F.col("rep").alias("node"), "id"), "node")
    named = named.groupBy("root").agg(F.min("id").alias("component_id"))
    linked = roots.join(named, "root")
    by_set = reps.select("digest", "id", "rep").join(linked, F.col("rep") == F.col("node"), "left")
    by_set = by_set.select("digest", F.coalesce("root", "rep").alias("root"), F.coalesce("component_id", "id").alias("component_id"))
    lonely = F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("digest"))
    return signed.select("id", "stamp", "n", lonely.alias("digest")), by_set


def jaccard_components(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of each row; sets link when den * intersection >= num * union."""
    signed, by_set = _components(docs, size, num, den, key, text)
    joined = signed.join(by_set, "digest", "left")
    return joined.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.coalesce("component_id", "id").alias("component_id"))


def first_of_components(docs: DataFrame, size: int = 3, num: int = 90, den: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` with one (key, text) of each component: the smallest key, of its texts that with the smallest md5.

    Rows without id or words all stay; of rows with equal key and text one stays, without id all.
    """
    signed, by_set = _components(docs, size, num, den, key, text)
    first = signed.join(by_set, "digest").groupBy("root").agg(F.min(F.struct("id", "stamp")).alias("first"))
    first = first.select("first.*").unionByName(signed.where("digest IS NULL AND id IS NOT NULL").select("id", "stamp"))
    of_it = ["id of it", "stamp of it"]
    first = materialise(first.distinct().toDF(*of_it), "jaccard-first-of")
    seen = signed.where("id IS NOT NULL").groupBy(F.col("id").alias(of_it[0]), F.col("stamp").alias(of_it[1])).agg(F.count("*").alias("m"))
    doubtful = seen.join(first.withColumn("stays", F.lit(True)), of_it, "left").where("m > 1 OR stays IS NULL")
    stamp = F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))
    found = docs.where(F.col(key).isNotNull()).withColumns({of_it[0]: F.col(key).cast("long"), of_it[1]: stamp})
    asked, sure = _parted(found, doubtful, *of_it)  # texts are wide; a row that goes, or of which there are more, is asked for
    kept = asked.join(first, of_it, "left_semi").dropDuplicates([*of_it, key, text])
    return kept.unionByName(sure).select(*docs.columns).unionByName(docs.where(F.col(key).isNull()))
