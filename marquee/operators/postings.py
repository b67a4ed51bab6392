"""The inverted index as tables: postings, field statistics, documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.functions.analysis import ANALYZERS, PLAIN, Analyzer
from marquee.functions.counting import Coded, Runs, coded, runs, steps
from marquee.functions.hashing import utf8, xxhash64
from marquee.functions.packing import packed, unpacked
from marquee.session import shuffles_dropped

# Index field -> document column.  The analysed title sits beside the raw one.
FIELDS = {"summary": "summary", "content": "content", "movie_title_t": "movie_title"}


POSTINGS_PER_BATCH = 50_000  # what travels back to the JVM at once
MIN_BUCKETS, DOCS_PER_BUCKET = 16, 500_000
FILES = {"compression": "zstd"}


def build_postings(
    docs: DataFrame,
    fields: dict[str, str] = FIELDS,
    analyzer: Analyzer = PLAIN,
    doc_id: str = "id",
) -> DataFrame:
    """(field, term, id, tf, positions, field_len, lead), one row per term of a field.

    A document's words are analysed in its own row; inside the task the words of
    a batch are coded and sorted by (term, document, position), and each run of
    one term in one document becomes a posting.  Building needs no shuffle, and
    the postings of a batch leave in the order of the index.  ``field_len`` rides
    along to spare the search a join; ``lead`` marks one posting of each
    document's field, so that documents can be counted.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    analysed = docs.select(
        F.col(doc_id).alias("id"), *[analyzer.slots(F.col(column)).alias(f"s{i}") for i, column in enumerate(fields.values())]
    )
    names = sorted(fields)
    columns = {name: f"s{i}" for i, name in enumerate(fields)}

    def work(batches):
        for batch in batches:
            for step in steps(batch, list(columns.values())):
                step = step.take(pc.sort_indices(step.column("id")))
                for name in names:
                    yield from _field_postings(name, step.column("id"), step.column(columns[name]))

    return analysed.mapInArrow(
        work, f"field string, term string, id {kind}, tf int, positions array<int>, field_len int, lead boolean"
    )


@dataclass(frozen=True)
class _Postings:
    """A field's postings in a step: row, code of the term and whether it leads, in the order of the runs."""

    found: Coded
    run: Runs
    rows: np.ndarray
    codes: np.ndarray
    lead: np.ndarray


def _postings(slots: pa.ListArray) -> _Postings:
    found = coded(slots)
    run = runs(found.rows, found.codes)
    rows, codes = found.rows[run.order[run.starts]], found.codes[run.order[run.starts]]
    lead = np.zeros(len(rows), dtype=bool)
    lead[np.unique(rows, return_index=True)[1]] = True  # runs go by term: a row's first one
    return _Postings(found, run, rows, codes, lead)


def _field_postings(name: str, ids: pa.Array, slots: pa.ListArray) -> Iterator[pa.RecordBatch]:
    made = _postings(slots)
    found, run, rows, codes, lead = made.found, made.run, made.rows, made.codes, made.lead
    if not len(rows):
        return
    sizes = np.bincount(found.rows, minlength=len(ids)).astype(np.int32)
    places = pa.array(found.places[run.order].astype(np.int32))
    for low in range(0, len(rows), POSTINGS_PER_BATCH):
        part = slice(low, low + POSTINGS_PER_BATCH)
        first, end = run.starts[part][0], run.starts[part][-1] + run.lengths[part][-1]
        edges = pa.array(np.append(run.starts[part], end).astype(np.int64) - first, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(pa.scalar(name), len(rows[part])),
                found.words.take(pa.array(codes[part])),
                ids.take(pa.array(rows[part])),
                pa.array(run.lengths[part].astype(np.int32)),
                pa.ListArray.from_arrays(edges, places.slice(first, end - first)),
                pa.array(sizes[rows[part]]),
                pa.array(lead[part]),
            ],
            names=["field", "term", "id", "tf", "positions", "field_len", "lead"],
        )


def packed_postings(docs: DataFrame, analyzer: Analyzer, buckets: int, files_per_bucket: int) -> DataFrame:
    """(deal, ids, packed): the postings that a batch has for one file of the index, as one row.

    ``build_postings`` for a shuffle: as rows, postings repeat their term, id and
    length, and take five times the room.  ``unpacked_postings`` is the way back.
    """
    kind = docs.schema["id"].dataType.simpleString()
    part = F.pmod(F.xxhash64("id"), F.lit(files_per_bucket)).cast("int")
    names = sorted(FIELDS)
    analysed = docs.select("id", part.alias("part"), *[analyzer.slots(F.col(FIELDS[f])).alias(f) for f in names])

    def work(batches):
        for batch in batches:
            for step in steps(batch, names):
                step = step.take(pc.sort_indices(step.column("id")))
                yield from _packed_step(step, names, buckets, files_per_bucket)

    return analysed.mapInArrow(work, f"deal int, ids array<{kind}>, packed binary")


def _packed_step(step: pa.RecordBatch, names: list[str], buckets: int, files_per_bucket: int) -> Iterator[pa.RecordBatch]:
    ids, part = step.column("id"), step.column("part").to_numpy()
    fields = [_postings(step.column(name)) for name in names]
    if not any(len(f.rows) for f in fields):
        return
    words = pa.concat_arrays([f.found.words.cast(pa.string()) for f in fields])
    before = np.cumsum([0, *[len(f.found.words) for f in fields]])  # the fields' terms stand one after the other
    field_of = np.repeat(np.arange(len(names)), np.diff(before))
    bucket = np.concatenate([xxhash64(f.found.words, name) for f, name in zip(fields, names)]) % buckets
    sizes = np.stack([np.bincount(f.found.rows, minlength=len(ids)) for f in fields], axis=1)
    code = np.concatenate([f.codes + n for f, n in zip(fields, before)])
    row, lead, tf = (np.concatenate([made(f) for f in fields]) for made in (lambda f: f.rows, lambda f: f.lead, lambda f: f.run.lengths))
    gap = np.concatenate([_gaps(f.found.places[f.run.order], f.run.starts) for f in fields])

    deal = bucket[code] * files_per_bucket + part[row]
    if buckets * files_per_bucket <= 1 << 16:
        deal = deal.astype(np.uint16)  # radix sort
    order = np.argsort(deal, kind="stable")
    gap = gap[np.argsort(np.repeat(deal, tf), kind="stable")]
    deal, row, code, lead, tf = deal[order].astype(np.int64), row[order], code[order], lead[order], tf[order]
    edges = np.flatnonzero(np.diff(deal, prepend=-1, append=-1))
    gap_edges = np.append(0, np.cumsum(tf))[edges]
    held, blocks = [], []
    for low, high, first, end in zip(edges, edges[1:], gap_edges, gap_edges[1:]):
        here, number = np.unique(row[low:high], return_inverse=True)
        starts = np.flatnonzero(np.diff(code[low:high], prepend=-1))
        terms = code[low:high][starts]
        offsets, data = utf8(words.take(pa.array(terms)))
        held.append(here)
        blocks.append(
            packed(
                [
                    field_of[terms], np.diff(starts, append=high - low), np.diff(offsets), data, number, tf[low:high],
                    sizes[here].ravel(), np.flatnonzero(lead[low:high]), gap[first:end],
                ]
            )
        )
    bounds = np.append(0, np.cumsum([len(h) for h in held]))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(deal[edges[:-1]].astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), ids.take(pa.array(np.concatenate(held)))),
            pa.array(blocks, pa.binary()),
        ],
        names=["deal", "ids", "packed"],
    )


def _gaps(places: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Places as steps from the one before, from 0 at the start of a run."""
    gaps = np.diff(places, prepend=0)
    gaps[starts] = places[starts]
    return gaps


def unpacked_postings(blocks: DataFrame) -> DataFrame:
    """The rows of ``build_postings`` from the blocks of ``packed_postings``."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    names = sorted(FIELDS)

    def work(batches):
        held, n = [], 0
        for batch in batches:
            columns = batch.column("ids"), batch.column("packed")
            for ids, block in zip(*columns):
                held.append(_block_postings(ids.values, block.as_py(), names))
                n += held[-1].num_rows
                if n >= POSTINGS_PER_BATCH:
                    yield from _in_parts(held)
                    held, n = [], 0
        if held:
            yield from _in_parts(held)

    return blocks.select("ids", "packed").mapInArrow(
        work, f"field string, term string, id {kind}, tf int, positions array<int>, field_len int, lead boolean"
    )


def _in_parts(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    whole = pa.concat_batches(held)
    for low in range(0, whole.num_rows, POSTINGS_PER_BATCH):
        yield whole.slice(low, POSTINGS_PER_BATCH)


def _block_postings(ids: pa.Array, block: bytes, names: list[str]) -> pa.RecordBatch:
    field_of, per_term, term_bytes, data, number, tf, sizes, leads, gap = unpacked(block, 9)
    offsets = np.append(0, np.cumsum(term_bytes)).astype(np.int32)
    terms = pa.StringArray.from_buffers(len(term_bytes), pa.py_buffer(offsets), pa.py_buffer(data.astype(np.uint8)))
    term = np.repeat(np.arange(len(per_term)), per_term)
    edges = np.append(0, np.cumsum(tf))
    place = np.cumsum(gap)
    before = place[edges[:-1]] - gap[edges[:-1]]
    lead = np.zeros(len(tf), dtype=bool)
    lead[leads] = True
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names).take(pa.array(field_of[term])),
            terms.take(pa.array(term)),
            ids.take(pa.array(number)),
            pa.array(tf.astype(np.int32)),
            pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array((place - np.repeat(before, tf)).astype(np.int32))),
            pa.array(sizes.reshape(-1, len(names))[number, field_of[term]].astype(np.int32)),
            pa.array(lead),
        ],
        names=["field", "term", "id", "tf", "positions", "field_len", "lead"],
    )


def slot_count(slots: Column, analyzer: Analyzer) -> Column:
    """Index terms in an analysed text (gaps do not count)."""
    return F.size(slots) if analyzer.gapless else F.size(F.filter(slots, lambda w: w.isNotNull()))


def field_stats(postings: DataFrame) -> DataFrame:
    """(field, n_docs, total_len) over the documents that have the field at all."""
    return (
        postings.filter("lead")
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("field_len").alias("total_len"))
    )


@dataclass(frozen=True)
class SearchIndex:
    """The tables a search reads; ``buckets`` and ``terms`` are None for tables never written."""

    docs: DataFrame
    postings: DataFrame
    stats: DataFrame
    analyzer: Analyzer = PLAIN
    buckets: int | None = None
    terms: DataFrame | None = None


def bucket_of(buckets: int, *columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def write_index(
    docs: DataFrame,
    path: str,
    analyzer: Analyzer = PLAIN,
    mode: str = "errorifexists",
    buckets: int | None = None,
    files_per_bucket: int = 4,
) -> None:
    """Write postings, documents, document frequencies and field statistics.

    Postings lie in one folder per hash bucket of (field, term), documents in
    one per hash bucket of the id, and every file is sorted by its key.  A query
    opens only the folders of its terms, and there only the row groups with
    them.  Inside a bucket rows are dealt out by id: a very common term is
    written, and later read, by several tasks.  The number of buckets follows
    from the number of documents unless it is given.  A blank id fails the job:
    documents without a name would be one document to every search.

    Documents come first, and postings are made from them as they are stored: what
    ``docs`` is made of is read once for both.  Postings are shuffled as packed
    blocks, and no shuffle stays on disk beyond its own table.
    """
    spark = docs.sparkSession
    named = F.length(F.trim(F.coalesce("id", F.lit("")))) > 0
    docs = docs.filter(F.when(named, F.lit(True)).otherwise(F.raise_error(F.lit("a document has no id")).cast("boolean")))
    with shuffles_dropped(spark):
        if buckets is None:
            buckets = max(MIN_BUCKETS, -(-docs.count() // DOCS_PER_BUCKET))
        files = buckets * files_per_bucket
        (
            docs.withColumn("bucket", bucket_of(buckets, F.col("id")))
            .repartitionById(files, F.col("bucket") * files_per_bucket + F.pmod(F.hash("id"), F.lit(files_per_bucket)))
            .sortWithinPartitions("bucket", "id")
            .write.mode(mode)
            .options(**FILES)
            .partitionBy("bucket")
            .parquet(f"{path}/docs")
        )
        # What was there before an append has its postings already.
        source = docs if mode == "append" else spark.read.schema(docs.schema).parquet(f"{path}/docs")
        blocks = packed_postings(source, analyzer, buckets, files_per_bucket).repartitionById(files, F.col("deal"))
        (
            unpacked_postings(blocks)
            .withColumn("bucket", bucket_of(buckets, F.col("field"), F.col("term")))
            .sortWithinPartitions("bucket", "field", "term", "id")
            .write.mode(mode)
            .options(**FILES)
            .partitionBy("bucket")
            .parquet(f"{path}/postings")
        )
        written = spark.read.parquet(f"{path}/postings")
        counted = written.groupBy("bucket", "field", "term").agg(F.count(F.lit(1)).alias("df"))
        counted.sortWithinPartitions("field", "term").write.mode(mode).options(**FILES).parquet(f"{path}/terms")
        stats = field_stats(written).withColumn("buckets", F.lit(buckets)).withColumn("analyzer", F.lit(analyzer.name))
        stats.coalesce(1).write.mode(mode).parquet(f"{path}/stats")


def load_index(spark: SparkSession, path: str, analyzer: Analyzer | None = None) -> SearchIndex:
    """The index at ``path`` with the analyser it was written with; another one given is an error."""
    read = spark.read.parquet
    stats = read(f"{path}/stats")
    # One row per field.
    rows = stats.select("buckets", "analyzer").collect()
    buckets = max((r["buckets"] for r in rows), default=None)
    written = {r["analyzer"] for r in rows}
    if analyzer is not None and written - {analyzer.name}:
        raise ValueError(f"the index was written with the analyser {written}, not with {analyzer.name}")
    found = analyzer or next((ANALYZERS[name] for name in written), PLAIN)
    return SearchIndex(
        read(f"{path}/docs"), read(f"{path}/postings"), stats.drop("buckets", "analyzer"), found, buckets, read(f"{path}/terms")
    )
