"""Byte-level BPE encoding and decoding without a regex engine.

Pre-tokenisation: every code point becomes a class, every class with its
neighbours a symbol, every symbol a transition function of a small automaton.
Functions compose associatively, so the states of a whole batch come from a
blocked scan over them: compose inside all blocks at once, scan the blocks'
functions, then walk all blocks at once from their known states.  Where the
automaton says "a token begins here" a slice begins; distinct slices are merged
once and kept in a bounded cache.  Decoding joins the bytes of the ids; token
byte offsets lead from a token back to its place in the text.

Inputs and results that need saying: a null or empty text has no tokens; equal
rows give equal results, nothing is deduplicated; an empty table gives no rows;
further columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marquee.llm.pair_merge import BoundedCache, PairMerger
from marquee.llm.texts import steps

CACHED_SLICES = 400_000  # distinct slices a worker remembers

# Symbols: letter, number, other, apostrophe of a two- or three-character
# contraction, space or other white space before something else, white space
# before white space or the end, border between two texts.
L, N, O, A2, A3, S, V, W, R = range(9)
# States: nothing open, in letters, numbers, others, white space, after a space
# that belongs to what follows, one or two characters short of a contraction.
FRESH, IN_L, IN_N, IN_O, IN_W, ATTACH, ONE_MORE, TWO_MORE = range(8)
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a token begins with this symbol)."""
    if symbol == L:
        if state == ONE_MORE:
            return FRESH, False
        if state == TWO_MORE:
            return ONE_MORE, False
        return IN_L, state not in (IN_L, ATTACH)
    if symbol == N:
        return IN_N, state not in (IN_N, ATTACH)
    if symbol in (O, A2, A3):
        if symbol == O or state in (IN_O, ATTACH):
            return IN_O, state not in (IN_O, ATTACH)
        return (ONE_MORE if symbol == A2 else TWO_MORE), True
    if symbol == S:
        return ATTACH, True
    if symbol == W:
        return IN_W, state != IN_W
    return FRESH, True


@lru_cache(maxsize=1)
def _tables():
    """Classes of all code points, the automaton, and its functions' composition."""
    classes = np.full(0x110000, O, dtype=np.uint8)
    for code in range(0x110000):
        kind = unicodedata.category(chr(code))[0]
        if kind in "LN":
            classes[code] = L if kind == "L" else N
    classes[_WHITE] = W
    following = np.array([[_step(s, x)[0] for x in range(9)] for s in range(8)], dtype=np.uint8)
    begins = np.array([[_step(s, x)[1] for x in range(9)] for s in range(8)])
    functions = {tuple(range(8)): 0}
    generators = [tuple(int(following[s, x]) for s in range(8)) for x in range(9)]
    todo = [tuple(range(8))]
    while todo:  # every function that symbols can compose to
        f = todo.pop()
        for g in generators:
            if (h := tuple(g[f[s]] for s in range(8))) not in functions:
                functions[h] = len(functions)
                todo.append(h)
    every = list(functions)
    compose = np.array([[functions[tuple(g[f[s]] for s in range(8))] for g in every] for f in every], dtype=np.int16)
    of_symbol = np.array([functions[g] for g in generators], dtype=np.int16)
    from_fresh = np.array([f[FRESH] for f in every], dtype=np.uint8)
    return classes, following.ravel(), begins.ravel(), compose, of_symbol, from_fresh


def _symbols(codes: np.ndarray, borders: np.ndarray) -> np.ndarray:
    classes = _tables()[0]
    symbols = classes[codes]
    symbols[borders] = R
    after = np.append(symbols[1:], R)
    last_white = (symbols == W) & (after != W) & (after != R)
    symbols[last_white] = np.where(codes[last_white] == 0x20, S, V)
    quotes = np.flatnonzero(codes == ord("'"))
    if len(quotes):
        padded = np.append(codes, [0, 0])
        padded[borders] = 0
        first, second = padded[quotes + 1], padded[quotes + 2]
        short = np.isin(first, [ord(c) for c in "stmd"])
        long = ((first == ord("r")) | (first == ord("v"))) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        symbols[quotes[short]] = A2
        symbols[quotes[long]] = A3
    return symbols


def token_starts(codes: np.ndarray, borders: np.ndarray, block: int = 256) -> np.ndarray:
    """Positions at which a token or a border begins."""
    _, following, begins, compose, of_symbol, from_fresh = _tables()
    n = len(codes)
    if not n:
        return np.zeros(0, dtype=np.int64)
    blocks = -(-n // block)
    symbols = np.full(blocks * block, R, dtype=np.uint8)
    symbols[:n] = _symbols(codes, borders)
    symbols = np.ascontiguousarray(symbols.reshape(blocks, block).T)
    whole = of_symbol[symbols[0]]
    for row in symbols[1:]:
        whole = compose[whole, of_symbol[row]]
    reach = 1
    while reach < blocks:  # inclusive scan of the blocks' functions by doubling
        whole = np.concatenate([whole[:reach], compose[whole[:-reach], whole[reach:]]])
        reach *= 2
    state = np.zeros(blocks, dtype=np.uint8)
    state[1:] = from_fresh[whole[:-1]]
    flags = np.empty((block, blocks), dtype=bool)
    for j, row in enumerate(symbols):
        at = state * np.uint8(9) + row
        flags[j] = begins[at]
        state = following[at]
    return np.flatnonzero(flags.T.ravel()[:n])


def _utf8_sizes(codes: np.ndarray) -> np.ndarray:
    sizes = np.ones(len(codes), dtype=np.int64)
    for bound in (0x80, 0x800, 0x10000):
        sizes += codes >= bound
    return sizes


def _kinds(raw: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slices with equal bytes: the number of each slice's kind, and one slice of each kind.

    Up to 16 bytes a slice is two integers, which tell it from every other one;
    longer slices are all kinds of their own.
    """
    starts, sizes = edges[:-1], np.diff(edges)
    padded = np.concatenate([raw, np.zeros(16, dtype=np.uint8)])
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    low, high = (np.ascontiguousarray(words[starts + k]).view(np.uint64).ravel() for k in (0, 8))
    shown = np.minimum(sizes, 16)
    low = low & _FIRST[np.minimum(shown, 8)]
    high = high & _FIRST[np.maximum(shown - 8, 0)]
    key = low * np.uint64(0x9E3779B97F4A7C15) ^ (high + sizes.astype(np.uint64)) * np.uint64(0xC2B2AE3D27D4EB4F)
    key[sizes > 16] = np.arange(int((sizes > 16).sum()), dtype=np.uint64)
    order = np.argsort(key, kind="stable")
    k, lo, hi, size = key[order], low[order], high[order], sizes[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (k[1:] != k[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1]) | (size[1:] != size[:-1]) | (size[1:] > 16)
    kind = np.empty(len(order), dtype=np.int64)
    kind[order] = np.cumsum(new) - 1
    return kind, order[new]


_FIRST = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)  # masks of a word's first bytes


def read_ranks(path: str) -> list[bytes]:
    """Bytes by rank from a rank file: a base64 string and a number on each line."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


class ByteBpe:
    """Encoder and decoder for one rank file."""

    def __init__(self, path: str):
        self.vocabulary = read_ranks(path)
        self.names = [str(i) for i in range(len(self.vocabulary))]
        ids = {token: i for i, token in enumerate(self.vocabulary)}
        self._byte = np.array([ids[bytes([b])] for b in range(256)], dtype=np.int32)
        self._merger = PairMerger(
            (ids[token[:k]], ids[token[k:]], i, i)
            for token, i in ids.items()
            for k in range(1, len(token))
            if token[:k] in ids and token[k:] in ids
        )
        self._cache: BoundedCache = BoundedCache(CACHED_SLICES)

    def _learn(self, slices: list[bytes]) -> list[list[int]]:
        lengths = np.fromiter(map(len, slices), dtype=np.int64, count=len(slices))
        symbols = self._byte[np.frombuffer(b"".join(slices), dtype=np.uint8)]
        merged = self._merger.merge_all(symbols, lengths)
        self._cache.make_room()
        self._cache.update(zip(slices, merged))
        return merged

    def _ids_of(self, slices: list[bytes]) -> list[list[int]]:
        found = list(map(self._cache.get, slices))
        if None in found:
            new = [i for i, ids in enumerate(found) if ids is None]
            for i, ids in zip(new, self._learn([slices[i] for i in new])):
                found[i] = ids
        return found

    def encode(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text."""
        raw = "\n".join(texts).encode()
        codes = np.frombuffer(raw.decode().encode("utf-32-le"), dtype=np.uint32)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        ends = np.cumsum(lengths + 1) - 1
        starts = token_starts(codes, ends[:-1])
        where = np.concatenate([[0], np.cumsum(_utf8_sizes(codes))])
        edges = where[np.append(starts, len(codes))]
        kind, example = _kinds(np.frombuffer(raw, dtype=np.uint8), edges)
        ids = self._ids_of([raw[edges[i] : edges[i + 1]] for i in example.tolist()])
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum()))
        n_ids = sizes[kind]
        until = np.cumsum(n_ids)
        shift = (np.cumsum(sizes) - sizes)[kind] - (until - n_ids)
        every = flat[np.arange(int(n_ids.sum())) + np.repeat(shift, n_ids)]
        before = np.concatenate([[0], until])
        first = before[np.searchsorted(starts, ends - lengths)]
        last = before[np.searchsorted(starts, ends)]
        for a, b in zip(first.tolist(), last.tolist()):
            yield every[a:b].tolist()

    def offsets(self, ids: list[int]) -> list[int]:
        """The byte in the text's UTF-8 at which each token begins."""
        sizes = np.fromiter((len(self.vocabulary[i]) for i in ids), dtype=np.int64, count=len(ids))
        return (np.cumsum(sizes) - sizes).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, ids))


@lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    gc.set_threshold(200_000, 20, 50)  # lists of ids hold no cycles; looking through them costs more than encoding
    return ByteBpe(path)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, offsets) of each row; ``path`` names the rank file on every executor."""
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            for first, texts in steps(batch, text):
                ids = list(bpe.encode(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(first, len(texts)),
                        pa.array(ids, pa.list_(pa.int32())),
                        pa.array([bpe.offsets(x) for x in ids], pa.list_(pa.int64())),
                    ],
                    names=[key, "ids", "offsets"],
                )

    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, ids array<int>, offsets array<bigint>")


def decode(encoded: DataFrame, path: str, key: str = "doc_id") -> DataFrame:
    """(key, bytes, text) from ids; bytes that are no UTF-8 show as U+FFFD in the text."""
    kind = encoded.schema[key].dataType.simpleString()

    def work(batches):
        bpe = byte_bpe(path)
        for batch in batches:
            raw = [bpe.decode(ids or []) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(raw, pa.binary()), pa.array([r.decode(errors="replace") for r in raw], pa.string())],
                names=[key, "bytes", "text"],
            )

    return encoded.select(key, "ids").mapInArrow(work, f"`{key}` {kind}, bytes binary, text string")


def round_trip(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, decode what was encoded, and keep a digest of both sides per row.

    One pass, so that ids and bytes need not leave the worker.
    """
    kind = docs.schema[key].dataType.simpleString()

    def work(batches):
        bpe = byte_bpe(path)
        names = bpe.names
        for batch in batches:
            for first, texts in steps(batch, text):
                counts, id_digests, byte_digests, lengths = [], [], [], []
                for ids in bpe.encode(texts):
                    raw = bpe.decode(ids)
                    counts.append(len(ids))
                    lengths.append(len(raw))
                    id_digests.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                    byte_digests.append(hashlib.sha256(raw).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).slice(first, len(texts)), pa.array(counts, pa.int64()),
                        pa.array(id_digests, pa.string()), pa.array(byte_digests, pa.string()), pa.array(lengths, pa.int64()),
                    ],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "n_bytes"],
                )

    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint"
    return docs.select(key, text).mapInArrow(work, schema)
