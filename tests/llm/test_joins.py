"""Joins and searches against brute force on small rows with nulls, ties and repeats."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marquee.llm import cap_dedup, cover_topk, jaccard_join, texts, url_rules
from marquee.llm.components import connected_components

VECTORS = "vec_id long, embedding array<float>, label int, score string"


def vectors(n=300, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 16))
    for i in range(0, n, 5):  # near copies of the next four
        x[i + 1 : i + 5] = x[i] + 0.08 * rng.standard_normal((4, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = [(i, [float(np.float32(v)) for v in x[i]], int(i // 5 % 3), "s") for i in range(n)]
    rows += [(n + i, rows[0][1], 0, None) for i in range(4)]  # exact copies
    rows += [(900, None, 0, "s"), (901, [], 0, "s"), (902, [0.0] * 16, 0, "s"), (903, [float("nan")] + [0.1] * 15, 0, "s"),
             (904, [None] + [0.1] * 15, 0, "s"), (905, rows[0][1], None, "s"), (906, [float("inf")] + [0.1] * 15, 1, "s")]
    return rows


def roots(n, linked, names):
    root = list(names)
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


@pytest.mark.parametrize("block", [2048, 3])
def test_near_duplicate_embeddings(spark, block):
    rows = vectors()
    got = {r["vec_id"]: r for r in cap_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS), block=block).collect()}
    usable = [i for i, (_, e, l, _) in enumerate(rows) if e and l is not None and None not in e and np.isfinite(e).all() and any(e)]
    x = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in usable}
    linked = [(a, b) for a in usable for b in usable if a < b and rows[a][2] == rows[b][2] and x[a] @ x[b] >= 0.93]
    degree = [sum(i in pair for pair in linked) for i in range(len(rows))]
    want = roots(len(rows), linked, [r[0] for r in rows])
    assert len(got) == len(rows) and len(linked) > 100
    for i, row in enumerate(rows):
        r = got[row[0]]
        assert (r["n_links"], r["component_id"], r["kept"]) == (degree[i], want[i], want[i] == row[0])


def test_every_filter_that_is_exceeded_is_listed():
    rng = np.random.default_rng(2)
    unit = rng.standard_normal((20, 16))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    left, right = cap_dedup._block_scores(unit, 32, 1)
    scores = left[:, :, None] + right[:, None, :]
    for row, found in zip(scores.reshape(20, -1), cap_dedup.exceeded_in(unit, 32, 0.7, 1)):
        assert sorted(found) == np.flatnonzero(row >= 0.7).tolist() and len(found)


def test_recall_of_the_filters_at_the_threshold():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal(x.shape)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    pairs = zip(cap_dedup.exceeded(x), cap_dedup.exceeded(0.93 * x + np.sqrt(1 - 0.93**2) * z))
    assert np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) >= 0.99


@pytest.mark.parametrize("dim", [16, 64])
def test_recall_stays_with_more_codewords(dim):
    rng = np.random.default_rng(4)
    x, z = rng.standard_normal((2, 300, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    words = cap_dedup.words_for(60_000)
    pairs = zip(cap_dedup.exceeded(x, words=words), cap_dedup.exceeded(0.93 * x + np.sqrt(1 - 0.93**2) * z, words=words))
    assert words > 1900 and np.mean([len(np.intersect1d(a, b)) > 0 for a, b in pairs]) >= 0.97


def test_directions_grow_with_the_vectors():
    """Four times the vectors of a label make about four times the pairs in buckets, not sixteen times."""
    rng = np.random.default_rng(5)
    pairs = []
    for n in (1000, 4000):
        x = rng.standard_normal((n, 32))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        sizes = np.unique(np.concatenate(cap_dedup.exceeded(x, words=cap_dedup.words_for(n))), return_counts=True)[1]
        pairs.append((sizes * (sizes - 1) // 2).sum())
    assert cap_dedup.words_for(1000) == cap_dedup.WORDS and pairs[1] < 6 * pairs[0]


def test_filters_met_before():
    import pyarrow as pa

    lists = [[1, 5, 9], [5, 9], [], [1, 2, 9, 70_000_000_000], [70_000_000_000]]
    left, right = np.array([0, 0, 0, 3, 1, 2]), np.array([1, 1, 3, 4, 3, 4])
    this = np.array([9, 5, 9, 70_000_000_000, 9, 9])
    got = cap_dedup._met_before(pa.array(lists, pa.list_(pa.int64())), this, left, right)
    assert got.tolist() == [True, False, True, False, False, False]
    table = pa.table({"f": pa.array([[0], *lists], pa.list_(pa.int64()))}).slice(1)
    assert (cap_dedup._met_before(table.column("f").combine_chunks(), this, left, right) == got).all()


@pytest.mark.parametrize(("small", "block", "full"), [(1, 2048, 1000), (3, 3, 1), (16, 2048, 1)])
def test_groups_of_all_sizes_and_more_codewords(spark, monkeypatch, small, block, full):
    monkeypatch.setattr(cap_dedup, "SMALL", small)
    monkeypatch.setattr(cap_dedup, "FULL", full)
    df = spark.createDataFrame(vectors(150), VECTORS)
    want = cap_dedup.near_duplicates(df, block=2048).collect()
    monkeypatch.undo()
    assert sorted(cap_dedup.near_duplicates(df, block=block).collect(), key=str) == sorted(want, key=str)


def test_empty_embeddings(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert cap_dedup.near_duplicates(empty).count() == 0
    assert cover_topk.top_k(empty, F.col("vec_id") % 50 == 0).count() == 0


@pytest.mark.parametrize("part", [4096, 40])
def test_top_k_is_exact_with_ties(spark, part):
    rows = vectors()
    got = cover_topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0, part=part).collect()
    usable = [(i, np.floor(256 * np.array(e))) for i, e, _, _ in rows if e and None not in e and np.isfinite(e).all()]
    want = set()
    for q, x in usable:
        if q % 50 == 0:
            ranked = sorted((-int(x @ y), i) for i, y in usable if i != q)[:5]
            want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)}
    assert {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got} == want
    assert len(got) == len(want)


def test_top_k_with_few_candidates(spark):
    rows = [(0, [0.5, 0.5], 1, ""), (50, [0.25, -1.0], 1, ""), (7, [1.0], 1, "")]
    got = cover_topk.top_k(spark.createDataFrame(rows, VECTORS), F.col("vec_id") % 50 == 0).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in got} == {(0, 1, 50), (50, 1, 0)}


def test_components(spark):
    edges = [(i, i + 1) for i in range(10, 40)] + [(100, i) for i in range(101, 130)] + [(5, 5), (130, 3), (130, 129)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert {k for k, v in got.items() if v == 10} == set(range(10, 41))
    assert {k for k, v in got.items() if v == 3} == {3, *range(100, 131)}
    assert connected_components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_jaccard(rows, size, num, den):
    sets = []
    for _, text in rows:
        words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        k = min(size, len(words))
        sets.append({tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set())
    pairs = [
        (a, b) for a in range(len(rows)) for b in range(a)
        if sets[a] and sets[b] and rows[a][0] is not None and rows[b][0] is not None
        and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])
    ]
    names = [r[0] if r[0] is not None else -1 for r in rows]
    return [(rows[i][0], len(sets[i]), None if rows[i][0] is None else c) for i, c in enumerate(roots(len(rows), pairs, names))]


def copies():
    rng = np.random.default_rng(8)
    rows = []
    for group in range(12):
        base = [f"w{rng.integers(400)}" for _ in range(int(rng.integers(3, 160)))]
        for _ in range(14 if group < 3 else 3):
            words = list(base)
            for _ in range(int(rng.integers(0, 4))):
                words[int(rng.integers(len(words)))] = f"x{rng.integers(9)}"
            rows.append((len(rows), "Shared line of text\x0b" * int(group % 2) + " ".join(words)))
    rows += [(700, None), (701, ""), (702, " \t\n"), (703, "one"), (704, "One two"), (705, "one  TWO"), (None, rows[0][1]),
             (706, "É é"), (707, "é é"), (708, rows[0][1].upper()), (709, "a\xa0b c d"), (710, "a b c d")]
    return rows


def repeated_ids():
    """Ids 5 and 8 have an unrelated text and one with a partner, 9 two similar ones that no smaller id joins."""
    text = {name: " ".join(f"{name}{i}" for i in range(40)) for name in "abcdef"}
    near = {name: t + " end" for name, t in text.items()}
    return [(5, text["a"]), (5, text["b"]), (3, near["b"]), (9, text["c"]), (9, near["c"]), (9, text["c"]), (8, text["d"]), (8, text["e"]),
            (8, text["e"].upper()), (12, near["e"]), (9, text["f"]), (9, ""), (9, None), (None, text["a"])]


@pytest.mark.parametrize("block", [512, 3])
def test_repeated_ids_with_different_texts(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = repeated_ids()
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    order = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted(map(tuple, found), key=order) == sorted(brute_jaccard(rows, 3, 90, 100), key=order)


def test_sets_go_only_to_points_within_reach(spark, monkeypatch):
    """Texts whose counts rule each other out get no sets, in neither round; results are as by brute force."""
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)
    asked, inner = [], jaccard_join._with_sets
    monkeypatch.setattr(jaccard_join, "_with_sets", lambda rows, tokens: asked.append(rows) or inner(rows, tokens))
    counted = []
    meet = jaccard_join._meet
    monkeypatch.setattr(jaccard_join, "_meet", lambda rows, *rest: counted.append(asked[-1].count()) or meet(rows, *rest))
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(i, shared + " " + " ".join(f"t{j}" for j in range(k))) for i, k in enumerate([*range(0, 36, 2), *range(200, 900, 50)])]
    monkeypatch.setattr(jaccard_join, "CELL", 4)  # a cell too large for pairs joins all of them to one family
    found = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90, 100).collect()
    assert sorted(map(tuple, found)) == sorted(brute_jaccard(rows, 3, 90, 100))
    assert len(counted) == 2 and counted[0] < 2 * len(rows) and counted[1] < len(rows)


def test_repeated_ids_with_different_vectors(spark):
    eye = np.eye(16)
    rows = [(5, eye[0]), (5, eye[1]), (3, eye[1] + 0.1 * eye[2]), (5, eye[4]), (7, eye[4] - 0.1 * eye[5]), (3, eye[7])]
    rows = [(i, [float(v) for v in x], 0, "s") for i, x in rows]
    got = [tuple(r) for r in cap_dedup.near_duplicates(spark.createDataFrame(rows, VECTORS)).collect()]
    assert sorted(got) == sorted([(5, 0, 5, True), (5, 1, 3, False), (3, 1, 3, True), (5, 1, 5, True), (7, 1, 5, False), (3, 0, 3, True)])


@pytest.mark.parametrize(("size", "num", "cell", "block"), [(3, 90, 512, 512), (3, 90, 2, 4), (5, 80, 4, 3)])
def test_jaccard_components(spark, monkeypatch, size, num, cell, block):
    monkeypatch.setattr(jaccard_join, "CELL", cell)
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    rows = copies()
    docs = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, n int")
    got = [tuple(r) for r in jaccard_join.jaccard_components(docs, size, num, 100).collect()]
    assert sorted(got, key=str) == sorted(brute_jaccard(rows, size, num, 100), key=str)


def test_jaccard_of_nothing(spark):
    assert jaccard_join.jaccard_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_the_bound_is_never_below_the_intersection():
    sets = jaccard_join.shingle_sets([t or "" for _, t in copies()], 3)
    points = np.stack([np.bincount((s & np.uint64(31)).astype(int), minlength=32) for s in sets])
    bound = jaccard_join._overlap(points, points)
    assert all(bound[a, b] >= len(np.intersect1d(sets[a], sets[b])) for a in range(len(sets)) for b in range(a))


def test_parities_never_differ_more_than_sets_and_tell_long_strangers_apart():
    rng = np.random.default_rng(6)
    for n in (3, 40, 400, 1800):
        base, other = rng.integers(1 << 62, size=(2, n), dtype=np.uint64)
        sets = [base, np.append(base[n // 10 :], other[: n // 12]), other]
        differ = lambda a, b: int(np.bitwise_count(jaccard_join._odd(a) ^ jaccard_join._odd(b)).sum())
        assert all(differ(a, b) <= len(np.setxor1d(a, b)) for a in sets for b in sets)
        may = lambda a, b: jaccard_join._few_apart(differ(a, b), len(a) + len(b), 80, 100)
        assert may(base, sets[1]) and not may(base, other)


def test_only_rows_in_doubt_are_shuffled(spark):
    """Of the texts that stay only those with a copy pass the last join; strangers are in no meeting."""
    words = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(300)]
    rows = [(i, t) for i, t in enumerate(words)] + [(1000 + i, words[i] + " more") for i in range(10)] + [(5, words[5]), (7, None), (None, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    some = docs.where("doc_id >= 1000").selectExpr("doc_id - 1000 AS doc_id")
    asked, sure = jaccard_join._parted(docs.where("doc_id IS NOT NULL"), some, "doc_id")
    assert {r[0] for r in asked.collect()} >= set(range(10)) and asked.count() < 30 and asked.count() + sure.count() == len(rows) - 1
    kept = [tuple(r) for r in jaccard_join.first_of_components(docs, 3, 80, 100).collect()]
    assert sorted(kept, key=str) == sorted([*enumerate(words), (7, None), (None, "a b")], key=str)


def test_plans_hold_no_marks(spark):
    """The driver keeps the text of every plan, so a plan may not spell out half a megabyte of marks."""
    docs = spark.createDataFrame([(i, f"a b c d{i % 3} e f") for i in range(9)] + [(None, "a b c"), (9, None)], "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    docs.count()
    before = store.executionsList().last().executionId()
    assert jaccard_join.first_of_components(docs, 3, 80, 100).count() == 5
    kept = store.executionsList()
    plans = [e.physicalPlanDescription() for e in map(kept.apply, range(kept.size())) if e.executionId() > before]
    assert len(plans) > 20 and max(map(len, plans)) < 200_000


def test_marks_tell_every_row_apart(spark):
    """Each row is in one of the two parts, also with null keys, equal keys, or no marks at all."""
    rows = [(i % 70, b"x" if i % 3 else None, i) for i in range(200)] + [(None, None, 200), (None, b"y", 201)]
    docs = spark.createDataFrame(rows, "id long, digest binary, at int")
    some = docs.where("id < 5 OR id IS NULL")
    asked, sure = jaccard_join._parted(docs, some, "id", "digest")
    assert asked.columns == sure.columns == docs.columns
    inside, outside = ({r["at"] for r in part.collect()} for part in (asked, sure))
    assert inside >= {r["at"] for r in some.collect()} and not inside & outside and len(inside | outside) == asked.count() + sure.count() == len(rows)
    none, every = jaccard_join._parted(docs, docs.where("false"), "id", "digest")
    assert none.isEmpty() and every.count() == len(rows)


def test_a_worker_forgets_the_model_of_an_earlier_stage():
    texts.only_model(list, "abc")
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "text": ["a b c d", None]})
    assert [out.num_rows for out in jaccard_join._points("id", "text", 3, 80, 100)([batch])] == [2] and not texts._MODEL


def test_finer_counts_keep_every_link_and_drop_long_strangers():
    rng = np.random.default_rng(3)
    sets = []
    for n in (40, 127, 128, 520, 9000):
        base = rng.integers(1 << 62, size=n, dtype=np.uint64)
        sets += [np.unique(base), np.unique(base[: n - n // 25]), np.unique(np.append(base, base[: n // 22] + np.uint64(1)))]
        sets.append(np.unique(rng.integers(1 << 62, size=n, dtype=np.uint64)))
    n = np.array([len(s) for s in sets])
    common = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    linked = jaccard_join._enough(common, n, n, 90, 100) & ~np.eye(len(n), dtype=bool)
    fine = [jaccard_join._fine(s) for s in sets]
    coarse = np.stack([jaccard_join._folded(f, 32) for f in fine])
    near = jaccard_join._surviving(coarse, n, 90, 100)
    assert near[-1, -4]  # in few groups long strangers look alike
    assert (jaccard_join._thinned(near, [f.astype("<u2").tobytes() for f in fine], n, 90, 100) == linked).all() and linked.sum() >= 20


@pytest.mark.parametrize("num", [50, 80, 90, 97])
def test_similar_sets_share_a_key_of_contents(num):
    """At every size, also where groups stay empty."""
    contents, rng = jaccard_join.Contents(num, 100), np.random.default_rng(num)
    for n in [*range(2, 60), 100, 333, 1000]:
        a = np.unique(rng.integers(1 << 63, size=n, dtype=np.uint64) * np.uint64(2))
        gone = len(a) - -(-num * len(a) // 100)  # as many as may go
        b = np.sort(rng.permutation(a)[gone:])
        for other in (b, a[gone:]):
            if gone and len(other):
                assert len(np.intersect1d(contents.keys(a), contents.keys(other)))


RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/", "allow"), ("EXAMPLE.com", "/de/", "block"),
         ("a.example.com", "/", "allow"), ("org", "", "block"), (None, "/", "block")]
URLS = ["http://example.net/en/1", "http://www.Example.NET/EN/1", "https://x.net", "x.net/", None, "", "ftp://b.example.com/de/?q=/en/",
        "http://a.example.com/de/x#y", "http://notexample.com/de/", "://org?x", "http://org", "http://net/#", "a://b.net:80/", "http:///p"]


def brute_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match("[^/?#]*", rest)[0]
        path = re.match("[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(h.lower() + p, a) for h, p, a in RULES if h and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
    rule, action = min(fit, key=lambda r: (-len(r[0]), r[1] != "block", r[0]), default=(None, "allow"))
    return host, path, rule, action


def test_url_rules(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS * 3)] + [(None, URLS[0], "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    got = sorted(map(str, (tuple(r) for r in url_rules.judge_urls(pages, rules).collect())))
    assert got == sorted(str((i, *brute_verdict(u))) for i, u, _ in rows)
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_rules.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}
