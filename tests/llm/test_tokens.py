"""Byte-level BPE, token counts and packing against the libraries and by invariants."""

import base64
import gc
import hashlib
import pickle
import random
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm import byte_bpe, packing, token_counts, toxicity
from marquee.llm.word_bpe import WordBpe, word_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = "  \n\t'''sStTrevlmdxyzAÉé12½３ßñİıΣσ\x1c\x85\xa0　.,!?|<>😀一"


@pytest.fixture(scope="module")
def reference():
    ranks = dict(zip(byte_bpe.read_ranks(RANKS), range(10**6)))
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def noise(n, seed=3):
    rng = random.Random(seed)
    parts = [*PIECES, "<|endoftext|>", "<|ENDOFTEXT|>", "'re", "the ", "token"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for _ in range(n)]


LONG = ["a" * 20_000, "ab " * 3000, "!" * 3000 + " " * 2000 + "x", "thisisonelongword" * 500]


def test_byte_ids_are_the_librarys(reference):
    bpe = byte_bpe.byte_bpe(RANKS)
    texts = noise(3000) + LONG
    assert list(bpe.encode(texts)) == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(), max_size=5))
def test_byte_bpe_round_trip(texts):
    bpe = byte_bpe.byte_bpe(RANKS)
    for text, ids in zip(texts, bpe.encode(texts), strict=True):
        raw = bpe.decode(ids)
        assert raw.decode() == text
        offsets = bpe.offsets(ids)
        assert [raw[a:b] for a, b in zip(offsets, offsets[1:] + [len(raw)])] == [bpe.vocabulary[i] for i in ids]


def test_scan_does_not_depend_on_blocks():
    text = "It's  a\n\n test, they'll 'see'  12 x"
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    starts = [byte_bpe.token_starts(codes, np.zeros(0, np.int64), block).tolist() for block in (1, 3, 8, 256)]
    assert starts[0] == starts[1] == starts[2] == starts[3]


def test_byte_frames(spark, reference):
    rows = [(1, "Hello world", "x"), (1, "Hello world", "x"), (2, "", "y"), (3, None, None), (None, "ü\n", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = byte_bpe.round_trip(docs, RANKS).collect()
    assert len(got) == 5
    by = {(r["doc_id"], r["n_tokens"]): r for r in got}
    ids = reference.encode_ordinary("Hello world")
    want = by[(1, len(ids))]
    assert want["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert want["decoded_sha256"] == hashlib.sha256(b"Hello world").hexdigest()
    assert by[(3, 0)]["ids_sha256"] == hashlib.sha256(b"").hexdigest()
    encoded = byte_bpe.encode(docs, RANKS)
    assert sorted(r["text"] for r in byte_bpe.decode(encoded, RANKS).collect()) == ["", "", "Hello world", "Hello world", "ü\n"]
    assert byte_bpe.round_trip(docs.limit(0), RANKS).count() == 0


def test_rank_file_is_read_in_order():
    first = open(RANKS, "rb").readline().split()
    assert byte_bpe.read_ranks(RANKS)[int(first[1])] == base64.b64decode(first[0])


def test_word_ids_and_counts_are_the_librarys(library):
    texts = noise(3000, 5) + LONG
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(raw, "<u4").tolist() for raw in word_bpe(WORDS).encode(texts)] == want
    assert token_counts.token_counter(WORDS).count(texts) == [len(ids) for ids in want]


def test_ids_of_a_step_are_the_librarys(library):
    rng = random.Random(9)
    parts = [
        "'s", "'t", "'re", "'ve", "'ll", "'d", "'m", "'", "r", "e", "l", "s", "see", "é", "½", "²", "12", " ", " ", "\u0301", "\x00", "\x1c",
        "’", "ß", "ǆ", "İ", "Σ", "<|endoftext|>", "<|", "!", "\u3000", "\x85", "ñandú", "x" * 17, "é" * 8, "é" * 9, "ȯ", "Ȱ", "中", "😀",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3000)] + ["", " ", "'", "a'"]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    bpe = WordBpe(WORDS)
    for step in (1, 50, len(texts)):
        got = [np.frombuffer(raw, "<u4").tolist() for i in range(0, len(texts), step) for raw in bpe.encode(texts[i : i + step])]
        assert got == want
    assert bpe.encode([]) == []


def test_known_pieces_are_bounded(library, monkeypatch):
    monkeypatch.setattr("marquee.llm.word_bpe.CACHED_PIECES", 300)
    bpe, rng = WordBpe(WORDS), random.Random(4)
    for _ in range(20):
        texts = [" ".join("".join(rng.choices("abcé", k=rng.randint(3, 9))) for _ in range(20)) for _ in range(20)]
        got = [np.frombuffer(raw, "<u4").tolist() for raw in bpe.encode(texts)]
        assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
        assert len(bpe._pieces) <= 300 + 400


def test_words_not_seen_before_are_not_learned_one_by_one(library):
    """Their text is split and merged as a whole; only odd words and long pre-tokens are Python strings."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdeé", k=7)) + rng.choice(",.!") for _ in range(50)) for _ in range(50)]
    bpe, asked = WordBpe(WORDS), []
    learn = bpe.learn
    bpe.learn = lambda words: asked.extend(words) or learn(words)
    got = [np.frombuffer(raw, "<u4").tolist() for raw in bpe.encode([*texts, "日本語 " + "x" * 17])]
    assert got[:-1] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert sorted(asked) == ["x" * 17, "日本語"]


def test_workers_keep_one_model():
    made = [word_bpe(WORDS), toxicity._scorer(pickle.dumps(None))]
    freed = weakref.ref(made.pop(0))
    gc.collect()
    assert freed() is None  # another stage's model does not stay beside it
    assert toxicity._scorer(pickle.dumps(None)) is made[0]
    assert token_counts.token_counter(WORDS) is token_counts.token_counter(WORDS)


def test_whole_tokens_are_one_token(library):
    whole = sorted(token_counts.token_counter(WORDS).whole)
    assert len(whole) > 10_000
    assert all(len(e.ids) == 1 for e in library.encode_batch(whole[::97], add_special_tokens=False))


def test_counts_frame(spark, library):
    docs = spark.createDataFrame([(1, "it's two"), (2, None), (2, ""), (None, "x " * 3000)], "doc_id long, text string")
    got = {(r["doc_id"], r["n_bytes"]): (r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(docs, WORDS).collect()}
    assert got == {(1, 8): (len(library.encode("it's two", add_special_tokens=False).ids), False), (2, 0): (0, False), (None, 6000): (3000, True)}
    assert token_counts.token_counts(docs.limit(0), WORDS).count() == 0


def best_fit_decreasing(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        gap = min(fit) if fit else capacity
        if fit:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=80))
def test_sweep_is_best_fit_decreasing(lengths):
    runs = [(n, 0, lengths.count(n)) for n in set(lengths)]
    places, _ = packing.sweep(runs, [], 40, 0)
    used = {}
    for length, _, n, first, per, at in places:
        for i in range(n):
            used.setdefault(first + i // per, []).append((at + i % per * length, length))
    assert sum(map(len, used.values())) == len(lengths)
    for own in used.values():
        end = 0
        for at, length in sorted(own):
            assert at == end
            end += length
        assert end <= 40
    assert len(used) == best_fit_decreasing(lengths, 40)


@pytest.mark.parametrize("per_shard", [10**6, 40])
def test_packing_documents(spark, library, per_shard):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["the", "token", "x"]) for _ in range(rng.choice([1, 5, 30, 30, 60, 150])))) for i in range(150)]
    rows += [(500, None), (501, ""), (501, ""), (None, "the token")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.token_pieces(docs, WORDS, 64)
    packed = packing.pack(packing.materialise(pieces, "test-pieces"), 64, pieces_per_shard=per_shard).collect()
    want = []
    for key, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for number, start in enumerate(range(0, len(ids), 64)):
            part = ids[start : start + 64]
            want.append((str(key), number, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    got = [(str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"], r["ids"]) for r in packed]
    assert sorted(got) == sorted(want)
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 64
    least = best_fit_decreasing([w[3] for w in want], 64)
    assert len(sequences) <= (least if per_shard > 1000 else least + 4 * 6)
    assert packing.pack_documents(docs.limit(0), WORDS).count() == 0
