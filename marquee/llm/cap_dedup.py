"""Near-duplicate embeddings by spherical-cap filters.

A filter is a direction; a vector belongs to it when it lies in the cap around
it.  Directions are a product code: a random rotation (signs and a Hadamard
transform) splits a vector into blocks, each block has its own random codewords,
and every combination of one word from each block is a direction.  So half
a million directions cost four thousand codewords, and all directions that a
vector exceeds are listed by walking the sorted block scores, never by trying all.
There are as many directions more as the largest label has vectors, so that buckets
stay as full as they are in a small table.  Vectors are
joined on (label, filter) and every pair in a bucket is verified by its cosine in
double precision, those of many small buckets at once.  A pair is counted in the first filter that both exceed.

Equal vectors are one vector with a weight before any of this.  A bucket above
``BLOCK`` vectors is dealt to pairs of blocks, each a group of its own, so that
no group outgrows a task and no pair is left out.  Pairs never leave a group:
counts do, and one edge for each vector that is not its group's smallest.

Inputs and results that need saying: a vector that is null, empty, zero, of
another length than the first valid one's, or holds a null or non-finite
component links with nothing, nor does one whose label or id is null; each keeps
its row with 0 links and itself as component; equal vectors with equal labels
link; equal ids count as separate rows; an empty table gives no rows; further
columns are not looked at.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.components import connected_components
from marquee.session import materialise

THRESHOLD = 0.93
CODES = 8  # product codes, each with a rotation of its own
WORDS = 256  # codewords of each of a code's two blocks, at least
FULL = 1000  # vectors of a label for which that many words are enough
FILTERS = 70  # filters that a random vector exceeds on average; fixes the height of the caps in any dimension
SCORES = 1 << 21  # block scores that are held at once
BLOCK = 2048  # vectors that one group compares with another
SMALL = 16  # vectors up to which groups of one size are compared together
PAIRS = 4096  # linked pairs whose filters are compared at once
_FINITE = "embedding IS NOT NULL AND size(embedding) > 0 AND forall(embedding, x -> x IS NOT NULL AND x = x AND abs(x) < double('inf')) AND exists(embedding, x -> x <> 0)"


@lru_cache(maxsize=64)
def _code(dim: int, words: int, seed: int) -> tuple[np.ndarray, int, list[np.ndarray]]:
    """Signs, padded dimension and the codewords of the two blocks."""
    random = np.random.default_rng(seed)
    padded = 1 << max(1, math.ceil(math.log2(dim)))
    signs = random.choice([-1.0, 1.0], size=(3, padded))
    books = [random.standard_normal((words, padded // 2)) for _ in range(2)]
    return signs, padded, [b / np.linalg.norm(b, axis=1, keepdims=True) for b in books]


@lru_cache(maxsize=64)
def cap_height(dim: int, words: int, seed: int, filters: float) -> float:
    """The score that random unit vectors reach in ``filters`` directions of a code on average."""
    unit = np.random.default_rng(99).standard_normal((64, dim))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    left, right = (-np.sort(-scores, axis=1) for scores in _block_scores(unit, words, seed))
    most = int(64 * filters)
    first, second = np.nonzero(np.outer(np.arange(1, min(words, most) + 1), np.arange(1, min(words, most) + 1)) <= most)
    every = (left[:, first] + right[:, second]).ravel()  # without those that ``most`` others of their own vector exceed
    return float(np.partition(every, -most)[-most])


def words_for(largest: int) -> int:
    """Codewords for a largest label of that many vectors: directions, the square of it, grow as the vectors."""
    return max(WORDS, math.ceil(WORDS * math.sqrt(largest / FULL)))


def _hadamard(x: np.ndarray) -> np.ndarray:
    n, width = x.shape[1], 1
    while width < n:
        x = x.reshape(len(x), -1, 2, width)
        x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(len(x), n)
        width *= 2
    return x / math.sqrt(n)


def _block_scores(unit: np.ndarray, words: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The products of both blocks of the rotated vectors with all codewords."""
    signs, padded, books = _code(unit.shape[1], words, seed)
    x = np.zeros((len(unit), padded))
    x[:, : unit.shape[1]] = unit
    for s in signs:
        x = _hadamard(x * s)
    return x[:, : padded // 2] @ books[0].T, x[:, padded // 2 :] @ books[1].T


def exceeded_in(unit: np.ndarray, words: int, height: float, seed: int) -> list[np.ndarray]:
    """For each unit vector the filters of one product code whose score is at least ``height``."""
    out = []
    for left, right in zip(*_block_scores(unit, words, seed)):
        first = np.flatnonzero(left >= height - right.max())
        second = np.flatnonzero(right >= height - left.max())
        second = second[np.argsort(-right[second])]
        counts = np.searchsorted(-right[second], left[first] - height, side="right")  # second words enough for each first
        out.append(np.concatenate([np.zeros(0, np.int64), *[i * words + second[:n] for i, n in zip(first, counts)]]))
    return out


def exceeded(unit: np.ndarray, codes: int = CODES, words: int = WORDS, filters: float = FILTERS) -> list[np.ndarray]:
    """For each unit vector all filters it exceeds, in order."""
    filters *= (words / WORDS) ** (4 / unit.shape[1])  # in few dimensions smaller caps lose more pairs
    heights = [cap_height(unit.shape[1], words, seed, filters / codes) for seed in range(codes)]
    rows, out = max(1, SCORES // words), []
    for at in range(0, len(unit), rows):
        found = [exceeded_in(unit[at : at + rows], words, height, seed) for seed, height in enumerate(heights)]
        out += [np.sort(np.concatenate([f + i * words * words for i, f in enumerate(own)])) for own in zip(*found)]
    return out


def _code_rows(words: int):
    def work(batches):
        for batch in batches:
            raw = np.stack(batch.column("embedding").to_numpy(zero_copy_only=False)) if batch.num_rows else np.zeros((0, 1))
            unit = raw.astype(np.float64)
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            lists = exceeded(unit, words=words) if batch.num_rows else []
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("label"), batch.column("weight"),
                 pa.array([v.tobytes() for v in raw], pa.binary()), pa.array(lists, pa.list_(pa.int64()))],
                names=["rep", "label", "weight", "raw", "filters"],
            )

    return work


def _earlier(filters: list[np.ndarray], this: int, other: list[np.ndarray]) -> np.ndarray:
    """Whether two vectors share a filter before this one, for all pairs of two lists."""
    left, right = [f[f < this] for f in filters], [f[f < this] for f in other]
    known, place = np.unique(np.concatenate([*left, *right, np.zeros(0, np.int64)]), return_inverse=True)
    if not len(known):
        return np.zeros((len(left), len(right)), dtype=bool)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(f) for f in (*left, *right)])
    order = np.argsort(place, kind="stable")
    place, rows = place[order], rows[order]
    shared = np.zeros((len(left), len(right)), dtype=bool)
    edges = np.flatnonzero(np.diff(place, prepend=-1, append=len(known)))
    for a, b in zip(edges[:-1], edges[1:]):
        mine = rows[a:b][rows[a:b] < len(left)]
        theirs = rows[a:b][rows[a:b] >= len(left)] - len(left)
        if len(mine) and len(theirs):
            shared[np.ix_(mine, theirs)] = True
    return shared


def _roots(linked: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The smallest name in the component of each row of a symmetric matrix."""
    names = names.copy()
    while True:
        least = np.where(linked, names[None, :], names[:, None]).min(axis=1)
        if (least == names).all():
            return names
        names = least


def _met_before(filters: pa.Array, this: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether each pair of rows shares a filter before the one it is met in."""
    values, ends = filters.flatten().to_numpy(), np.cumsum(np.append(0, filters.value_lengths().to_numpy()))
    longest = int(np.diff(ends).max(initial=0))
    out = np.zeros(len(left), dtype=bool)
    for at in range(0, len(left), PAIRS):
        sides = []
        for rows, none in ((left[at : at + PAIRS], -1), (right[at : at + PAIRS], -2)):
            place = ends[rows][:, None] + np.arange(longest)
            own = values[np.minimum(place, len(values) - 1)]
            sides.append(np.where((place < ends[rows + 1][:, None]) & (own < this[at : at + PAIRS, None]), own, none))
        both = np.sort(np.concatenate(sides, axis=1), axis=1)
        out[at : at + PAIRS] = ((both[:, 1:] == both[:, :-1]) & (both[:, 1:] >= 0)).any(axis=1)
    return out


_MEMBERS = ["label", "filter", "one", "two", "rep", "weight", "raw", "filters", "mine"]


def _verify(threshold: float, dtype: str):
    """(rep, links, a smaller linked rep or itself), from groups of members that exceed one filter."""

    def large(members: slice, x, reps, weights, side, filters, this: int, cross: bool):
        """A row for each linked member, with the smallest rep it is connected to here."""
        linked = x[members] @ x[members].T >= threshold
        np.fill_diagonal(linked, False)
        if cross:  # only pairs of different blocks
            linked &= side[members, None] != side[None, members]
        some = np.flatnonzero(linked.any(axis=1))
        linked = linked[np.ix_(some, some)]
        lists = [filters[members.start + i].values.to_numpy() for i in some.tolist()]
        counted = linked & ~_earlier(lists, this, lists)
        return reps[members][some], counted @ weights[members][some], _roots(linked, reps[members][some])

    def small(starts: np.ndarray, size: int, x, side, cross):
        """Linked pairs of rows in groups of one size."""
        rows = starts[:, None] + np.arange(size)
        linked = np.triu(x[rows] @ x[rows].transpose(0, 2, 1) >= threshold, 1)
        linked &= ~cross[starts][:, None, None] | (side[rows][:, :, None] != side[rows][:, None, :])
        group, i, j = np.nonzero(linked)
        return starts[group] + i, starts[group] + j

    def groups(table: pa.Table, starts: np.ndarray, sizes: np.ndarray):
        if not len(starts):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 3, names=["rep", "links", "root"])
        this, one, two, reps, weights, side = (table.column(c).to_numpy() for c in ("filter", "one", "two", "rep", "weight", "mine"))
        x = np.frombuffer(b"".join(table.column("raw").to_pylist()), dtype=dtype).reshape(table.num_rows, -1).astype(np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        filters, cross = table.column("filters").combine_chunks(), one != two
        none, out, pairs = np.zeros(0, dtype=np.int64), [], []
        for size in np.unique(sizes[sizes > 1]).tolist():
            here = starts[sizes == size]
            if size > SMALL:
                out += [large(slice(i, i + size), x, reps, weights, side, filters, this[i], cross[i]) for i in here.tolist()]
            else:
                step = max(1, SCORES // (size * x.shape[1]))
                pairs += [small(here[at : at + step], size, x, side, cross) for at in range(0, len(here), step)]
        a, b = (np.concatenate([none, *part]) for part in zip(*pairs)) if pairs else (none, none)
        if len(a):
            first = ~_met_before(filters, this[a], a, b)  # each pair is given once, where it meets first
            a, b = a[first], b[first]
            root = np.minimum(reps[a], reps[b])
            out += [(reps[a], weights[b], root), (reps[b], weights[a], root)]
        columns = [np.concatenate([none, *part]) for part in zip(*out)] if out else [none] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["rep", "links", "root"])

    def work(batches):
        held = []  # the last group, which may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([*held, batch.select(_MEMBERS)]).combine_chunks()
            keys = [table.column(c).to_numpy() for c in ("label", "filter", "one", "two")]
            new = np.logical_or.reduce([np.asarray(k[1:] != k[:-1], dtype=bool) for k in keys])
            starts = np.append(0, np.flatnonzero(new) + 1)
            yield groups(table.slice(0, starts[-1]), starts[:-1], np.diff(starts))
            held = table.slice(starts[-1]).to_batches()
        if held:
            table = pa.Table.from_batches(held).combine_chunks()
            yield groups(table, np.zeros(1, dtype=np.int64), np.array([table.num_rows]))

    return work


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = BLOCK) -> DataFrame:
    """(key, n_links, component_id, kept) of each row; vectors are compared within equal labels."""
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("embedding"), F.col(label).alias("label"))
    valid = rows.where(F.expr(_FINITE)).where("label IS NOT NULL AND id IS NOT NULL")
    one = valid.select(F.size("embedding").alias("n")).first()
    dim = one["n"] if one else 1
    valid = valid.where(F.size("embedding") == dim)
    reps = valid.groupBy("label", "embedding").agg(F.min("id").alias("id"), F.count("*").alias("weight"))
    reps = materialise(reps.withColumn("rep", F.monotonically_increasing_id()), "caps-vectors")  # ids may repeat, vectors do not
    kind = vectors.schema[label].dataType.simpleString()
    words = words_for(reps.groupBy("label").count().agg(F.max("count")).first()[0] or 0)
    coded = reps.drop("id").mapInArrow(_code_rows(words), f"rep bigint, label {kind}, weight bigint, raw binary, filters array<bigint>")
    coded = materialise(coded, "caps-coded")

    # Only buckets of two and more matter; those above the block size become pairs of blocks.
    slots = coded.select("label", "rep", F.explode("filters").alias("filter"))
    buckets = slots.groupBy("label", "filter").agg(F.count("*").alias("n")).where("n > 1")
    buckets = buckets.select("label", "filter", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
    dealt = slots.join(buckets, ["label", "filter"])
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "label", "filter", F.least("mine", "other").alias("one"), F.greatest("mine", "other").alias("two"), "rep", "mine"
    ).join(coded.select("label", "rep", "weight", "raw", "filters"), ["label", "rep"])
    group = ["label", "filter", "one", "two"]
    dtype = "float32" if "float" in dict(vectors.dtypes)[vector] else "float64"
    found = dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_verify(threshold, dtype), "rep bigint, links bigint, root bigint")
    found = materialise(found, "caps-found")

    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "rep", "root").select(F.col("node").alias("rep"), "root")
    named = roots.join(reps.select("rep", "id"), "rep").groupBy("root").agg(F.min("id").alias("component_id"))
    facts = reps.join(links, "rep", "left").join(roots.join(named, "root"), "rep", "left")
    facts = facts.select("label", "embedding", "weight", "links", F.coalesce("component_id", "id").alias("root"))
    usable = rows.withColumn("_key", F.when(F.expr(_FINITE) & (F.size("embedding") == dim) & F.col("id").isNotNull(), F.col("embedding")))
    joined = usable.join(facts.withColumnRenamed("embedding", "_key"), ["label", "_key"], "left")
    component = F.coalesce("root", "id")
    n_links = F.coalesce(F.col("links"), F.lit(0)) + F.coalesce(F.col("weight") - 1, F.lit(0))
    return joined.select(
        F.col("id").alias(key), n_links.alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept")
    )
