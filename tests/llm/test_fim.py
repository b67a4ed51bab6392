"""Fill-in-middle against slices of Python strings."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marquee.llm import fim

SCHEMA = "doc_id long, text string, n string, form string, output string, h1 long, key string"


def expected(key, text, plain_from=90, spm_below=20, seed=1):
    text, n = text or "", len(text or "")
    h = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in fim.MARKERS) or h3 % 100 >= plain_from:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_below:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def rows_of(texts):
    return [(i, t, "own", "own", "own", 1, "own") for i, t in enumerate(texts)]


def test_forms_against_slices(spark, monkeypatch):
    texts = [None, "", "a", "é", "\U0001d4c0", "€ü\U0001f600x" * 50, "has <P> inside", "<<S", "S>", "<S<M", "x" * 200_000, "né" * 300_000]
    texts += [f"text {i} " + "äöü€\U0001f600"[i % 5] * (i % 7) + " end" for i in range(200)]
    rows = rows_of(texts) + [(7, "twice", "", "", "", 0, ""), (7, "twice", "", "", "", 0, ""), (None, "no id", "", "", "", 0, "")]
    made = fim.fill_in_middle(spark.createDataFrame(rows, SCHEMA))
    found = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    got = sorted((str(r["doc_id"]), r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found)
    assert got == sorted((str(k), *expected(k, t)) for k, t, *_ in rows)
    assert sorted(r["back"] for r in found) == sorted(t or "" for _, t, *_ in rows)
    assert {r["form"] for r in found} == {"plain", "psm", "spm"}
    for r in found:
        if r["form"] != "plain":
            raw = r["back"].encode()
            assert len(raw[: r["prefix_bytes"]].decode()) == r["prefix_chars"]
            assert len(raw[r["prefix_bytes"] :][: r["middle_bytes"]].decode()) == r["middle_chars"]


def test_small_steps_and_other_rates(spark, monkeypatch):
    work = fim._transformed("key", fim.MARKERS, 100, 100)
    import pyarrow as pa

    monkeypatch.setattr(fim, "STEP_BYTES", 5)
    texts = ["ab€", None, "", "\U0001f600" * 9, "xyz", "é"]
    draws = {f"h{i}": pa.array(range(i, i + len(texts)), pa.int64()) for i in range(1, 5)}
    batch = pa.RecordBatch.from_pydict({"key": list(range(len(texts))), "text": pa.array(texts).fill_null(""), **draws})
    outs = [t for b in work([batch]) for t in b.column("output").to_pylist()]
    assert [o.replace("<S>", "").replace("<P>", "").replace("<M>", "") for o in outs if o] and len(outs) == len(texts)
    assert [sorted(o.translate(str.maketrans("", "", "<>PSM"))) for o in outs] == [sorted(t or "") for t in texts]
    sliced = [t for b in work([batch.slice(3, 2)]) for t in b.column("output").to_pylist()]
    assert sliced == outs[3:5]


def test_empty_table_and_markers(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert fim.fill_in_middle(none).collect() == []
    with pytest.raises(ValueError):
        fim.fill_in_middle(none, markers=("<P>", "<P>", "<M>"))
    with pytest.raises(ValueError):
        fim.fill_in_middle(none, markers=("P", "<S>", "<M>"))


@settings(max_examples=200, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])))
def test_positions(text):
    raw = text.encode()
    index = fim.Exceptions(np.frombuffer(raw, dtype=np.uint8))
    points = np.arange(len(text) + 1)
    at = np.array([len(text[:i].encode()) for i in points])
    assert (index.bytes(points) == at).all() and (index.points(at) == points).all()
