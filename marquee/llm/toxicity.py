"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word enters as its own embedding beside the sum of the embeddings of its
character n-grams, so that an unknown word is judged by its parts.  Two gated
recurrent layers read a window of words forwards and backwards, attention pools
their states, a logistic unit scores the window.  Windows overlap by half and
cover the whole text; a text's score is its highest window's.

The network is trained in numpy on a bounded sample of labelled rows
(``POSITIVES`` and ``NEGATIVES``): first on windows with their text's label, then,
since one bad passage makes a text bad, on each text's highest window.  Scoring
runs over Arrow batches; what a word contributes to the gates is worked out once
for each distinct word and kept in a bounded cache.

Inputs and results that need saying: a null or empty text, and one without
words, is an empty window and gets the score of one; equal texts get equal
scores; labels that are null, or of a document that is missing, are not used,
and of several labels of one document the highest counts; without labels of both
kinds every score is 0; an empty table gives no rows; further columns are kept by
``filter_toxic`` and not looked at otherwise.
"""

from __future__ import annotations

import gc
import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.texts import hashed_sample, only_model, steps

POSITIVES, NEGATIVES = 1000, 2400  # labelled rows that training uses at most, chosen by hash
WINDOW, STRIDE = 64, 32
HIDDEN, WIDTH = 8, 8  # units of a direction, size of each of the two embeddings
BUCKETS = 1 << 16  # hashed embeddings, of words and of n-grams each
GRAMS = (3, 5)  # bytes in a character n-gram, with marks at both ends of a word
THRESHOLD = 0.3
CACHED_WORDS = 125_000
EPOCHS = 8
_EDGE = b".,;:!?\"'()[]{}*&%$#|<>-_=+/\\~`^@"


def words_of(text: str) -> list[bytes]:
    return text.lower().encode().split()


def _hashed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (values >> np.uint64(48)).astype(np.int64) % BUCKETS


def features(words: list[bytes]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Per word the bucket of the word, and per gram size (word number, bucket) of its n-grams."""
    marked = [b"^" + (w.strip(_EDGE) or w) + b"$" for w in words]
    raw = np.frombuffer(b"".join(marked) + bytes(max(GRAMS)), dtype=np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    ends = np.cumsum(sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    at = np.arange(int(sizes.sum()))
    grams = []
    for n in GRAMS:
        value = np.full(len(at), n, dtype=np.uint64)
        for i in range(n):
            value = value * np.uint64(1099511628211) + raw[at + i]
        inside = at + n <= ends[owner]
        grams.append((owner[inside], _hashed(value[inside])))
    # a word's own bucket: a polynomial over all its bytes, place counted from its start
    place = (at - (ends - sizes)[owner]).astype(np.uint64)
    mixed = (raw[at] + place * np.uint64(257)) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    own = np.add.reduceat(mixed, ends - sizes) if len(words) else np.zeros(0, np.uint64)
    return _hashed(own), grams


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Parameters, forward pass and gradients."""

    def __init__(self, seed: int = 3):
        random = np.random.default_rng(seed)
        h, x = HIDDEN, 2 * WIDTH

        def normal(*shape):
            return (random.standard_normal(shape) / np.sqrt(shape[-2])).astype(np.float32)

        self.word = (0.02 * random.standard_normal((BUCKETS, WIDTH))).astype(np.float32)
        self.gram = (0.02 * random.standard_normal((BUCKETS, WIDTH))).astype(np.float32)
        self.dense = {
            "enter": normal(2, x, 3 * h), "bias": np.zeros((2, 3 * h), np.float32), "again": normal(2, h, 3 * h),
            "look": (0.3 * random.standard_normal(2 * h)).astype(np.float32),
            "out": (0.5 * random.standard_normal(2 * h)).astype(np.float32), "base": np.full(1, -1.0, np.float32),
        }

    def inputs(self, words: list[bytes]):
        own, grams = features(words)
        owner = np.concatenate([g[0] for g in grams])
        bucket = np.concatenate([g[1] for g in grams])
        order = np.argsort(owner, kind="stable")
        owner, bucket = owner[order], bucket[order]
        counts = np.bincount(owner, minlength=len(words))
        starts = np.cumsum(counts) - counts
        summed = np.zeros((len(words), WIDTH), np.float32)
        some = counts > 0
        if some.any():
            summed[some] = np.add.reduceat(self.gram[bucket], starts[some], axis=0)
        scale = (1 / np.sqrt(np.maximum(counts, 1))).astype(np.float32)[:, None]
        return np.concatenate([self.word[own], summed * scale], axis=1), (own, owner, bucket, scale)

    def gates(self, x: np.ndarray) -> np.ndarray:
        """What inputs add to the gates of both directions; the last row, for padding, keeps the state."""
        gates = np.matmul(x[None], self.dense["enter"]) + self.dense["bias"][:, None]
        pad = np.zeros((2, 1, 3 * HIDDEN), np.float32)
        pad[:, :, :HIDDEN] = 30
        return np.concatenate([gates, pad], axis=1)

    def gates_of(self, words: list[bytes], step: int = 20_000) -> np.ndarray:
        """``gates`` of many words, some at a time: their n-grams are many more than they."""
        parts = [self.gates(self.inputs(words[i : i + step])[0])[:, :-1] for i in range(0, len(words), step)]
        return np.concatenate([*parts, self.gates(np.zeros((0, 2 * WIDTH), np.float32))], axis=1)

    def forward(self, gates: np.ndarray, windows: np.ndarray, keep: bool = False):
        """Window logits; ``windows`` holds rows of ``gates``, the last one (padding) after a window's words."""
        h, again = HIDDEN, self.dense["again"]
        n, steps_ = windows.shape
        pad = gates.shape[1] - 1
        state = np.zeros((2, n, h), np.float32)
        states = np.empty((steps_, 2, n, h), np.float32)
        trace = []
        for t in range(steps_):
            into = np.stack([gates[0][windows[:, t]], gates[1][windows[:, steps_ - 1 - t]]])
            back = np.matmul(state, again)
            zr = into[:, :, : 2 * h] + back[:, :, : 2 * h]
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            z, r = zr[:, :, :h], zr[:, :, h:]
            new = np.tanh(into[:, :, 2 * h :] + r * back[:, :, 2 * h :])
            if keep:
                trace.append((state, z, r, new, back[:, :, 2 * h :]))
            state = new + z * (state - new)
            states[t] = state
        both = np.concatenate([states[:, 0], states[::-1, 1]], axis=2)  # time, window, unit
        energy = both @ self.dense["look"]
        energy[(windows == pad).T] = -1e9
        energy -= energy.max(axis=0)
        weight = np.exp(energy)
        weight /= weight.sum(axis=0)
        weight[(windows == pad).T] = 0
        pooled = np.einsum("tn,tnu->nu", weight, both)
        logits = pooled @ self.dense["out"] + self.dense["base"]
        return (logits, (both, weight, pooled, trace)) if keep else logits

    def gradients(self, gates, windows, labels, x):
        """Gradients of the mean logistic loss: of the dense parameters, and of the inputs by row."""
        h, again = HIDDEN, self.dense["again"]
        logits, (both, weight, pooled, trace) = self.forward(gates, windows, keep=True)
        n, steps_ = windows.shape
        error = ((_sigmoid(logits) - labels) / n).astype(np.float32)
        to_pooled = error[:, None] * self.dense["out"]
        energy = weight * (np.einsum("nu,tnu->tn", to_pooled, both) - (to_pooled * pooled).sum(axis=1))
        to_both = weight[:, :, None] * to_pooled + energy[:, :, None] * self.dense["look"]
        grad = {"out": error @ pooled, "base": error.sum(keepdims=True), "look": np.einsum("tn,tnu->u", energy, both)}
        grad["again"] = np.zeros_like(again)
        to_gates = np.zeros_like(gates)
        carry = np.zeros((2, n, h), np.float32)
        for t in range(steps_ - 1, -1, -1):
            state, z, r, new, back = trace[t]
            carry = carry + np.stack([to_both[t][:, :h], to_both[steps_ - 1 - t][:, h:]])
            to_new = carry * (1 - z) * (1 - new * new)
            to_z = carry * (state - new) * z * (1 - z)
            to_r = to_new * back * r * (1 - r)
            inner = np.concatenate([to_z, to_r, to_new * r], axis=2)
            grad["again"] += np.matmul(state.transpose(0, 2, 1), inner)
            carry = carry * z + np.matmul(inner, again.transpose(0, 2, 1))
            outer = np.concatenate([to_z, to_r, to_new], axis=2)
            np.add.at(to_gates[0], windows[:, t], outer[0])
            np.add.at(to_gates[1], windows[:, steps_ - 1 - t], outer[1])
        to_gates = to_gates[:, :-1]
        grad["enter"] = np.matmul(x.T[None], to_gates)
        grad["bias"] = to_gates.sum(axis=1)
        return grad, np.einsum("dng,dxg->nx", to_gates, self.dense["enter"])


def windows_of(n: int) -> list[tuple[int, int]]:
    """The overlapping windows of a text of n words."""
    if n <= WINDOW:
        return [(0, n)]
    return [(s, min(n, s + WINDOW)) for s in range(0, n - WINDOW + STRIDE, STRIDE)]


def _padded(rows: np.ndarray, spans: list[tuple[int, int]], pad: int) -> np.ndarray:
    out = np.full((len(spans), WINDOW), pad, dtype=np.int32)
    for i, (a, b) in enumerate(spans):
        out[i, : b - a] = rows[a:b]
    return out


def train(texts: list[str], labels: list[int], seed: int = 3, epochs: int = EPOCHS) -> Network | None:
    """The fitted network, or None without labels of both kinds."""
    if len(set(labels)) < 2:
        return None
    random, net = np.random.default_rng(seed), Network(seed)
    vocabulary: dict[bytes, int] = {}
    first, rows, owner, whole = 0, [], [], []
    for d, text in enumerate(texts):
        words = words_of(text)
        whole.append(np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), dtype=np.int32, count=len(words)))
        spans = windows_of(len(words))
        rows += [(first + a, first + b) for a, b in spans]
        owner += [d] * len(spans)
        first += len(words)
    names = list(vocabulary)
    pad = len(names)
    del vocabulary
    every = _padded(np.concatenate(whole), rows, pad)
    owner, truth = np.array(owner), np.array(labels, dtype=np.float32)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.dense.items()}
    sums = {"word": np.full(BUCKETS, 1e-8, np.float32), "gram": np.full(BUCKETS, 1e-8, np.float32)}
    count = 0
    per_text = 6  # windows of a text in one epoch
    for epoch in range(epochs):
        lot = random.random(len(owner))
        if epoch >= 2:  # the highest windows of each text instead of any
            gates = net.gates_of(names)
            score = np.concatenate([net.forward(gates, every[i : i + 2048]) for i in range(0, len(every), 2048)])
            lot = -score
        order = np.lexsort((lot, owner))
        place = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
        few = np.where(truth[owner[order]] > 0, per_text if epoch < 2 else 1, per_text // 2)
        chosen = order[place < few]
        random.shuffle(chosen)
        for at in range(0, len(chosen), 128):
            batch = chosen[at : at + 128]
            used, local = np.unique(every[batch], return_inverse=True)
            used = used[used < pad]
            x, (own, gram_owner, bucket, scale) = net.inputs([names[i] for i in used])
            gates = net.gates(x)
            grad, to_x = net.gradients(gates, np.minimum(local.reshape(len(batch), WINDOW), len(used)), truth[owner[batch]], x)
            count += 1
            for k, g in grad.items():
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                net.dense[k] -= 0.01 * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.99**count)) + 1e-8)
            for name, index, g in (
                ("word", own, to_x[:, :WIDTH]), ("gram", bucket, (to_x[:, WIDTH:] * scale)[gram_owner])
            ):
                table, seen = getattr(net, name), sums[name]
                spots, inverse = np.unique(index, return_inverse=True)
                total = np.zeros((len(spots), WIDTH), np.float32)
                np.add.at(total, inverse, g)
                seen[spots] += (total * total).mean(axis=1)
                table[spots] -= 0.05 * total / np.sqrt(seen[spots])[:, None]
    return net


class Scorer:
    def __init__(self, net: Network | None):
        self.net = net
        self._clear()

    def _clear(self) -> None:
        self.known: dict[bytes, int] = {}
        self.table = np.zeros((2, 0, 3 * HIDDEN), np.float32)

    def score(self, texts: list[str]) -> np.ndarray:
        """The highest window's score of each text."""
        if self.net is None:
            return np.zeros(len(texts))
        split = [words_of(t) for t in texts]
        new = list({w for words in split for w in set(words).difference(self.known)})
        if len(self.known) + len(new) > CACHED_WORDS:
            self._clear()
            new = list({w for words in split for w in words})
        if new:
            fresh = self.net.gates_of(new)[:, :-1]
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.table = np.concatenate([self.table, fresh], axis=1)
        pad = self.net.gates(np.zeros((0, 2 * WIDTH), np.float32))
        rows = np.fromiter((self.known[w] for words in split for w in words), dtype=np.int64)
        used, local = np.unique(rows, return_inverse=True)
        gates = np.concatenate([self.table[:, used], pad], axis=1)
        first, spans, owner = 0, [], []
        for d, words in enumerate(split):
            own = windows_of(len(words))
            spans += [(first + a, first + b) for a, b in own]
            owner += [d] * len(own)
            first += len(words)
        windows = _padded(local, spans, len(used))
        logits = np.concatenate([self.net.forward(gates, windows[i : i + 2048]) for i in range(0, len(windows), 2048)])
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, logits)
        return _sigmoid(best)


def _loaded(model: bytes) -> Scorer:
    return Scorer(pickle.loads(model))


def _scorer(model: bytes) -> Scorer:
    gc.set_threshold(200_000, 20, 50)
    return only_model(_loaded, model)


def held_out(key: Column) -> Column:
    """Rows whose labels are for testing: a quarter, by a checksum of the id; a null id is not among them."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
        positives: int = POSITIVES, negatives: int = NEGATIVES) -> Network | None:
    """The network trained on labelled rows for which ``learn`` holds, at most so many of each kind."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull()).where(learn)
    known = known.groupBy(key).agg(F.max(label).alias("_toxic"))
    known = known.select(F.col(key).alias("_key"), "_toxic")
    counts = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count("*").alias("n")).collect()}
    bounds = {1: positives, 0: negatives}
    some = [hashed_sample(known.where(F.col("_toxic") == y), 1.1 * bound, counts.get(y, 0), "_key") for y, bound in bounds.items()]
    wanted = F.broadcast(some[0].unionByName(some[1]))  # about 1.1 times the bounds
    sample = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).join(wanted, "_key").collect()
    sample.sort(key=lambda r: (zlib.crc32(str(r["_key"]).encode()), r["_text"] or ""))
    sample = [r for y, bound in bounds.items() for r in [s for s in sample if s["_toxic"] == y][:bound]]
    return train([r["_text"] or "" for r in sample], [r["_toxic"] for r in sample])


def score(docs: DataFrame, net: Network | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of each row."""
    kind = docs.schema[key].dataType.simpleString()
    model = pickle.dumps(net)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS and WIDTH fix its size: about 4 MB

    def work(batches):
        scorer = _scorer(shared.value)
        for batch in batches:
            for first, texts in steps(batch, text):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(key).slice(first, len(texts)), pa.array(scorer.score(texts), pa.float64())], names=[key, "score"]
                )

    return docs.select(key, text).mapInArrow(work, f"`{key}` {kind}, score double")


def filter_toxic(docs: DataFrame, net: Network | None, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with their columns, whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(net))

    def work(batches):
        scorer = _scorer(shared.value)
        for batch in batches:
            for first, texts in steps(batch, text):
                keep = scorer.score(texts) < threshold
                yield batch.slice(first, len(texts)).filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
