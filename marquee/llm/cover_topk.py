"""Exact top-k inner products by dual cover trees.

A cover tree keeps, at every node, a centre and the radius that covers all points
below it; children are more than half that radius apart.  For a node of queries
and a node of data no inner product exceeds

    cq.cd + rq |cd| + rd |cq| + rq rd,

so the pair is dropped when that is below the worst kth score of the query group.

The upper levels of both trees are tables: a bounded number of pivots deals the
vectors to cells with a centre and a radius; a large cell is dealt to parts of
about ``PART`` vectors, small ones share a part.  Every part of queries first meets the part of data with the
best bound, which sets its kth scores; then all other parts whose bound reaches
them.  Each meeting is a group of its own, in which both trees are descended
together.  Vectors are copied once for every part they meet, never collected.

Inputs and results that need saying: a vector that is null, empty, of another
length than the first valid one, or holds a null or non-finite component takes
no part, nor does a row whose id is null; a query is never its own candidate, by
id; of rows with equal ids each is a candidate, and the smallest vector is asked;
ties go to the smaller id; fewer candidates than k give fewer rows; an empty table
gives none; further columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.texts import hashed_sample
from marquee.session import materialise

K = 5
PART = 4096  # vectors in a part of the data or of the queries
PIVOTS = 64  # cells of the top level; their centres are the only vectors that reach the driver
LEAF = 32  # points below which a node is not divided


class Node:
    """A subtree: centre, covering radius, the points below it, and its children side by side."""

    __slots__ = ("centre", "children", "points", "radius", "centres", "norms", "radii")

    def __init__(self, x: np.ndarray, points: np.ndarray):
        own = x[points]
        squares = np.einsum("ij,ij->i", own, own)

        def from_point(i: int) -> np.ndarray:
            """Squared distances; exact, as all components are integers."""
            return squares - 2 * (own @ own[i]) + squares[i]

        self.points = points
        self.centre = own[0]
        near = from_point(0)
        furthest = float(near.max())
        self.radius = furthest**0.5
        self.children: list[Node] = []
        if len(points) > LEAF and furthest > 0:
            owner = np.zeros(len(points), dtype=np.int64)
            count = 1
            while near[far := int(near.argmax())] > furthest / 4:  # the farthest becomes the next centre
                distance = from_point(far)
                closer = distance < near
                owner[closer] = count
                near = np.minimum(near, distance)
                count += 1
            order = np.argsort(owner, kind="stable")
            for below in np.split(points[order], np.flatnonzero(np.diff(owner[order])) + 1):
                self.children.append(Node(x, below))
            self.centres = np.stack([c.centre for c in self.children])
            self.norms = np.linalg.norm(self.centres, axis=1)
            self.radii = np.array([c.radius for c in self.children])


def descend(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, floor: np.ndarray):
    """The k best (score, id) of each query among ``data``, but none whose score is below ``floor``."""
    scores = np.full((len(queries), k), -np.inf)
    names = np.full((len(queries), k), np.iinfo(np.int64).max)
    worst = floor.copy()

    def offer(q: np.ndarray, d: np.ndarray) -> None:
        found = queries[q] @ data[d].T
        found[query_ids[q][:, None] == ids[d][None, :]] = -np.inf
        for i, row in zip(q, found):
            good = np.flatnonzero((row >= worst[i]) & (row > -np.inf))
            if len(good):
                s, n = np.concatenate([scores[i], row[good]]), np.concatenate([names[i], ids[d[good]]])
                best = np.lexsort((n, -s))[:k]
                scores[i], names[i] = s[best], n[best]
                worst[i] = max(worst[i], scores[i, -1])

    def meet(q: Node, d: Node) -> None:
        reach = np.linalg.norm(q.centre)
        if q.centre @ d.centre + q.radius * np.linalg.norm(d.centre) + d.radius * (reach + q.radius) < worst[q.points].min() - 1e-6:
            return
        if q.children and (not d.children or q.radius >= d.radius):
            for child in q.children:
                meet(child, d)
        elif not d.children:
            offer(q.points, d.points)
        else:
            bound = d.centres @ q.centre + q.radius * d.norms + d.radii * (reach + q.radius)
            order = np.argsort(-bound)
            leaves: list[np.ndarray] = []
            for j in order:
                if bound[j] < worst[q.points].min() - 1e-6:
                    break
                child = d.children[j]
                if child.children:
                    meet(q, child)
                else:  # small subtrees are met many at a time
                    leaves.append(child.points)
                    if sum(map(len, leaves)) >= 256:
                        offer(q.points, np.concatenate(leaves))
                        leaves = []
            if leaves:
                offer(q.points, np.concatenate(leaves))

    if len(queries) and len(data):
        meet(Node(queries, np.arange(len(queries))), Node(data, np.arange(len(data))))
    return scores, names


def _meeting(k: int):
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        asked = rows["asks"].to_numpy()
        x = np.stack(rows["x"].to_numpy())
        ids = rows["id"].to_numpy()
        query_ids = ids[asked]
        scores, names = descend(x[asked], query_ids, x[~asked], ids[~asked], k, rows["floor"].to_numpy()[asked].astype(float))
        q, r = np.nonzero(scores > -np.inf)
        return pd.DataFrame({"query_id": query_ids[q], "id": names[q, r], "score": scores[q, r].astype(np.int64)})

    return work


def _parts(rows: DataFrame, pivots: np.ndarray, part: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with the part of each, and (part, centre, radius) of the parts."""

    def cells(batches):
        for pdf in batches:
            x = np.stack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, pivots.shape[1]))
            distance = np.sqrt(np.maximum(0, (x**2).sum(1)[:, None] - 2 * x @ pivots.T + (pivots**2).sum(1)[None, :]))
            cell = distance.argmin(axis=1) if len(pdf) else np.zeros(0, dtype=int)
            yield pdf.assign(cell=cell.astype(np.int32), away=distance[np.arange(len(pdf)), cell])

    kept = materialise(rows.mapInPandas(cells, "id bigint, x array<double>, cell int, away double"), name)
    plan, base, room = [], -1, 0  # a large cell has parts of its own, small ones share a part
    for size in kept.groupBy("cell").agg(F.count("*").alias("n")).orderBy("cell").collect():  # a row for each pivot
        if size["n"] > room:
            base, room = base + 1, part
        parts = -(-size["n"] // part)
        plan.append((size["cell"], base, parts))
        base, room = (base, room - size["n"]) if parts == 1 else (base + parts - 1, 0)
    places = rows.sparkSession.createDataFrame(plan, "cell int, base int, parts int")
    dealt = kept.join(F.broadcast(places), "cell")
    mine = (F.col("base") + F.pmod(F.xxhash64("id", "x"), F.col("parts"))).cast("long")
    dealt = dealt.select("id", "x", "away", "cell", mine.alias("part"))
    return dealt, dealt.groupBy("part", "cell").agg(F.max("away").alias("radius"))


def _bounds(queries: DataFrame, data: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(part, with, bound) of all pairs of parts, by the balls (cells) in each: their table, not the vectors'."""
    spark = queries.sparkSession
    n = len(pivots)
    norms = np.linalg.norm(pivots, axis=1)
    products = pivots @ pivots.T
    table = spark.createDataFrame(
        pd.DataFrame({"cq": np.repeat(np.arange(n), n), "cd": np.tile(np.arange(n), n), "product": products.ravel(),
                      "nq": np.repeat(norms, n), "nd": np.tile(norms, n)})
    )
    q = queries.select("part", F.col("radius").alias("rq"), F.col("cell").cast("long").alias("cq"))
    d = data.select(F.col("part").alias("with"), F.col("radius").alias("rd"), F.col("cell").cast("long").alias("cd"))
    bound: Column = F.col("product") + F.col("rq") * F.col("nd") + F.col("rd") * F.col("nq") + F.col("rq") * F.col("rd")
    return q.join(table, "cq").join(d, "cd").groupBy("part", "with").agg(F.max(bound + 1e-6).alias("bound"))


def _meet(pairs: DataFrame, queries: DataFrame, data: DataFrame, k: int) -> DataFrame:
    """The k best of each query in every pair of parts."""
    asks = queries.join(pairs.select("part", "with"), "part").select("part", "with", "id", "x", F.lit(True).alias("asks"), "floor")
    offers = data.withColumnRenamed("part", "with").join(pairs.select("part", "with"), "with")
    offers = offers.select("part", "with", "id", "x", F.lit(False).alias("asks"), F.lit(None).cast("double").alias("floor"))
    return asks.unionByName(offers).groupBy("part", "with").applyInPandas(_meeting(k), "query_id bigint, id bigint, score bigint")


def top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = 256, key: str = "vec_id", vector: str = "embedding", part: int = PART) -> DataFrame:
    """(query_id, rank, key, score): the k rows with the largest integer inner product for each query row."""
    x = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * scale).cast("double"))
    finite = F.forall(F.col(vector), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & (F.size(vector) > 0) & finite)
    rows = rows.select(F.col(key).cast("long").alias("id"), x.alias("x"), is_query.alias("asks"))
    first = rows.select(F.size("x").alias("n")).first()
    if first is None:
        return vectors.sparkSession.createDataFrame([], f"query_id bigint, rank int, {key} bigint, score bigint")
    rows = rows.where(F.size("x") == first["n"])
    sample = hashed_sample(rows.select("id", "x"), 16 * PIVOTS, rows.count(), "id", "x").collect()
    sample = sample or rows.select("x").limit(1).collect()  # chance may leave none of a few
    pivots = np.unique(np.array([r["x"] for r in sample]), axis=0)
    pivots = pivots[:: -(-len(pivots) // PIVOTS)]

    data, data_parts = _parts(rows.select("id", "x"), pivots, part, "topk-data")
    queries, query_parts = _parts(rows.where("asks").groupBy("id").agg(F.min("x").alias("x")), pivots, part, "topk-queries")
    bounds = materialise(_bounds(query_parts, data_parts, pivots), "topk-bounds")

    best = F.max_by("with", F.struct("bound", "with")).alias("with")
    first_pairs = bounds.groupBy("part").agg(best)
    opened = _meet(first_pairs, queries.withColumn("floor", F.lit(float("-inf"))), data, k)
    opened = materialise(opened, "topk-first")
    floors = opened.groupBy("query_id").agg(F.min("score").alias("worst"), F.count("*").alias("n")).where(F.col("n") >= k)
    known = queries.join(floors.select(F.col("query_id").alias("id"), "worst"), "id", "left")
    known = known.select("part", "id", "x", F.coalesce(F.col("worst").cast("double"), F.lit(float("-inf"))).alias("floor"))
    known = materialise(known, "topk-known")
    least = known.groupBy("part").agg(F.min("floor").alias("least"))
    rest = bounds.join(first_pairs, ["part", "with"], "left_anti").join(least, "part").where(F.col("bound") >= F.col("least"))
    later = _meet(rest, known, data, k)

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = opened.unionByName(later).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(key), "score")
