"""Best-fit packing of token pieces into sequences of fixed capacity.

Bulk-synchronous best fit.  Pieces are range-sorted by length, so that a piece
is known by its length and its rank among those of that length; equal pieces
form runs, and so do sequences with equal gaps.  A superstep takes the next band
of lengths, longest first.  Runs of pieces and of gaps are dealt by rank to
shards; every shard sweeps its lengths downwards and gives each run the smallest
gaps that hold it (its successors), several to a sequence where they fit.  The
i-th piece of a run takes the i-th place, so there is nothing to fight over;
what finds no gap opens sequences.  The new gaps are the next superstep's.
Runs number some thousands for each shard whatever the input; only the last
step, which hands places to pieces by (length, rank), touches rows again.

Inputs and results that need saying: a null or empty text is one piece, the end
id alone; equal rows are packed one by one; a null key is packed like any other
value; an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import heapq
import struct
import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.texts import steps
from marquee.llm.word_bpe import word_bpe
from marquee.session import materialise

CAPACITY = 2048
PIECES_PER_SHARD = 2_000_000  # pieces that one shard sweeps; fewer shards waste fewer half-filled sequences
BATCH_BYTES = 2 << 20  # of texts that travel to a Python worker at once
RANKS_PER_CHUNK = 1024  # ranks of one length that meet their places in one group
_RUNS = "shard int, kind string, size int, lo bigint, n bigint, first bigint, per bigint, at int"


def token_pieces(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 0, key: str = "doc_id", text: str = "text", with_ids: bool = True
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): each text's ids and the end id, cut only beyond ``capacity``."""
    kind = docs.schema[key].dataType.simpleString()
    end = struct.pack("<I", end_id)

    def work(batches):
        bpe = word_bpe(path)
        for batch in batches:
            for first, texts in steps(batch, text):
                rows: list[tuple] = []
                for i, raw in enumerate(bpe.encode(texts)):
                    raw += end
                    for piece, start in enumerate(range(0, len(raw), 4 * capacity)):
                        part = raw[start : start + 4 * capacity]
                        rows.append((first + i, piece, start // 4, len(part) // 4, zlib.crc32(part), part))
                at, piece, start, length, crc, parts = zip(*rows)
                columns = [
                    batch.column(key).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    edges = pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(edges, pa.array(np.frombuffer(b"".join(parts), dtype="<i4"))))
                yield pa.RecordBatch.from_arrays(columns, names=[key, "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return docs.select(key, text).mapInArrow(work, schema)


def sweep(pieces: list[tuple[int, int, int]], gaps: list[tuple[int, int, int]], capacity: int, next_sequence: int):
    """Best fit of runs of pieces (length, first rank, n) into runs of gaps (gap, first sequence, n).

    Returns places (length, first rank, n, first sequence, pieces per sequence, offset) and the gaps left over.
    """
    waiting = [(-g, s, n) for g, s, n in gaps]  # gaps smaller than any piece seen so far
    heapq.heapify(waiting)
    open_gaps: list[tuple[int, int, int]] = []  # the smallest last
    places = []

    def fill(length, rank, n, gap, first, bins):
        """Puts pieces of a run into sequences of a run; returns the ranks left and the sequences left."""
        per = gap // length
        full = min(bins, n // per)
        if full:
            places.append((length, rank, full * per, first, per, capacity - gap))
            if gap > per * length:
                heapq.heappush(waiting, (per * length - gap, first, full))
            rank, n, first, bins = rank + full * per, n - full * per, first + full, bins - full
        if n and bins:  # the run's last few share one more sequence
            places.append((length, rank, n, first, n, capacity - gap))
            heapq.heappush(waiting, (n * length - gap, first, 1))
            rank, n, first, bins = rank + n, 0, first + 1, bins - 1
        return rank, n, first, bins

    for length, rank, n in sorted(pieces, reverse=True):
        while waiting and -waiting[0][0] >= length:
            gap, first, bins = heapq.heappop(waiting)
            open_gaps.append((-gap, first, bins))
        while n and open_gaps:
            gap, first, bins = open_gaps.pop()
            rank, n, first, bins = fill(length, rank, n, gap, first, bins)
            if bins:
                open_gaps.append((gap, first, bins))
        if n:
            bins = -(-n // (capacity // length))
            fill(length, rank, n, capacity, next_sequence, bins)
            next_sequence += bins
    return places, [(g, s, n) for g, s, n in open_gaps if g] + [(-g, s, n) for g, s, n in waiting if g]


def _dealt(runs: DataFrame, shards: int) -> DataFrame:
    """Every run in ``shards`` parts of nearly equal size, by rank."""
    parts = runs.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    low = F.floor(F.col("n") * F.col("shard") / shards).cast("long")
    high = F.floor(F.col("n") * (F.col("shard") + 1) / shards).cast("long")
    return parts.withColumn("lo", F.col("lo") + low).withColumn("n", high - low).where("n > 0")


def _superstep(capacity: int, number: int, shards: int):
    def work(key, runs: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        of = {k: list(zip(r["size"].tolist(), r["lo"].tolist(), r["n"].tolist())) for k, r in runs.groupby("kind")}
        places, gaps = sweep(of.get("piece", []), of.get("gap", []), capacity, (number * shards + shard) << 36)
        rows = [(shard, "place", *p) for p in places] + [(shard, "gap", g, s, n, 0, 0, 0) for g, s, n in gaps]
        return pd.DataFrame(rows, columns=["shard", "kind", "size", "lo", "n", "first", "per", "at"])

    return work


def _bands(capacity: int) -> list[tuple[int, int]]:
    """Lengths by halves, longest first; the last band holds all that are short."""
    bands, high = [], capacity
    while high > max(1, capacity // 32):
        bands.append((high // 2 + 1, high))
        high //= 2
    return [*bands, (1, high)]


def pack(pieces: DataFrame, capacity: int = CAPACITY, key: str = "doc_id", pieces_per_shard: int = PIECES_PER_SHARD) -> DataFrame:
    """``pieces`` (key, piece, length, ...) with ``sequence_id`` and ``offset``.

    ``pieces`` should be stored: it is read twice.
    """
    spark = pieces.sparkSession
    order = ["length", key, "piece"]
    ranged = pieces.repartitionByRange(*order).sortWithinPartitions(*order)
    position = F.monotonically_increasing_id()
    ranged = ranged.withColumn("_range", F.shiftright(position, 33)).withColumn("_pos", position.bitwiseAND((1 << 33) - 1))
    ranged = materialise(ranged, "packing-sorted")

    # Ranks among the pieces of one length: by range, then by place in the range.
    slices = ranged.groupBy("_range", "length").agg(F.count("*").alias("n"), F.min("_pos").alias("_first"))
    before = Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("_first"))
    slices = materialise(slices, "packing-slices")
    total = slices.agg(F.sum("n")).first()[0] or 0
    shards = -(-total // pieces_per_shard) or 1

    runs = slices.groupBy("length").agg(F.sum("n").alias("n"))
    runs = runs.select(F.lit("piece").alias("kind"), F.col("length").cast("int").alias("size"), F.lit(0).cast("long").alias("lo"), "n")
    gaps, placed = spark.createDataFrame([], runs.schema), []
    for number, (low, high) in enumerate(_bands(capacity)):
        here = _dealt(runs.where(F.col("size").between(low, high)).unionByName(gaps), shards)
        step = here.groupBy("shard").applyInPandas(_superstep(capacity, number, shards), _RUNS)
        step = materialise(step, f"packing-step{number}")
        placed.append(step.where("kind = 'place'"))
        gaps = step.where("kind = 'gap'").select("kind", "size", "lo", "n")

    places = reduce(DataFrame.unionByName, placed)
    chunk = F.lit(RANKS_PER_CHUNK)
    last = F.col("lo") + F.col("n") - 1
    places = places.select(
        F.col("size").cast("long").alias("length"), "lo", last.alias("hi"), "first", "per", "at",
        F.explode(F.sequence(F.floor(F.col("lo") / chunk), F.floor(last / chunk))).alias("_chunk"),
    )
    ranked = ranged.join(slices.select("_range", "length", "_before"), ["_range", "length"])
    ranked = ranked.withColumn("_rank", F.col("_pos") + F.col("_before")).withColumn("_chunk", F.floor(F.col("_rank") / chunk))
    i = F.col("_rank") - F.col("lo")
    return (
        ranked.join(places, ["length", "_chunk"])
        .where(F.col("_rank").between(F.col("lo"), F.col("hi")))
        .select(
            *[ranked[c] for c in pieces.columns],
            (F.col("first") + F.floor(i / F.col("per"))).alias("sequence_id"),
            (F.col("at") + (i % F.col("per")) * F.col("length")).cast("long").alias("offset"),
        )
    )


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenise, cut and pack: (key, piece, start, length, ids_crc32, sequence_id, offset)."""
    conf, setting = docs.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    before = conf.get(setting)
    conf.set(setting, str(BATCH_BYTES))
    try:
        pieces = materialise(token_pieces(docs, path, capacity, key=key, text=text, with_ids=False), "packing-pieces")
    finally:
        conf.set(setting, before)
    return pack(pieces, capacity, key)
