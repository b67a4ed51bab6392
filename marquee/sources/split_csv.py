"""CSV with line breaks inside quotes, read by many tasks a file.

Spark splits a text file at lines, but a line may begin inside a quoted value, so
a task cannot tell alone where its first record begins.  A line is a function on
two states, *between records* and *inside quotes*, and so is a split: the
composition of its lines.  One pass works out the function of every split; a scan
over these few functions gives each split the state it begins with.  In a second
pass each task puts lines together to records from its first record on.  What a
split holds of records that cross its border, one piece at each end, is joined by
the record's first split.  No other row is moved.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marquee.session import materialise

BETWEEN, INSIDE = 0, 1  # states at the border of two lines
_LITERAL, _OPEN, _CLOSED = 0, 1, 2  # states behind a quote
_PIN = "spark.sql.files.minPartitionNum"


def quote_state(line: Column, before: int) -> Column:
    """The state after a line that begins in state ``before``.

    A quote opens a value at the beginning of a field only, that is after a comma
    or at the beginning of the record; inside, every quote closes, and one right
    behind it opens again (a doubled quote).  Elsewhere it is an ordinary character.
    """
    pieces = F.split(line, '"', -1)
    ahead = F.slice(pieces, F.lit(1), F.size(pieces) - 1)  # what stands before each quote

    def step(state: Column, piece: Column) -> Column:
        opens = piece.endswith(",") | ((piece == "") & (state == _CLOSED))
        return F.when(state == _OPEN, F.lit(_CLOSED)).when(opens, F.lit(_OPEN)).otherwise(F.lit(_LITERAL))

    folded = F.aggregate(ahead, F.lit(_CLOSED if before == BETWEEN else _OPEN), step)
    after = F.when(folded == _OPEN, F.lit(INSIDE)).otherwise(F.lit(BETWEEN))
    return F.when(F.contains(line, F.lit('"')), after).otherwise(F.lit(before))


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, split, line, from_between, from_inside), in the order of the file within each split."""
    line = F.col("value")
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        line.alias("line"),
        *[quote_state(line, s).cast("tinyint").alias(f"from_{n}") for s, n in ((BETWEEN, "between"), (INSIDE, "inside"))],
    )


def _split_functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each split: its function, and whether a record begins in it if it is entered inside quotes."""
    at, ends, begins, first = None, [], False, None
    names = ["file", "split", "from_between", "from_inside", "begins", "first"]

    def row():
        columns = zip(names, [*at, *ends, begins, first])
        return pa.RecordBatch.from_pydict({n: [v] for n, v in columns}, schema=_FUNCTION)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("file", "split", "from_between", "from_inside")]
        for i, (file, split, *after) in enumerate(zip(*columns)):
            if (file, split) != at:
                if at is not None:
                    yield row()
                at, ends, begins = (file, split), [BETWEEN, INSIDE], False
                first = batch.column("line")[i].as_py() if split == 0 else None
            begins = begins or ends[INSIDE] == BETWEEN
            ends = [after[s] for s in ends]
    if at is not None:
        yield row()


_FUNCTION = pa.schema(
    [("file", pa.string()), ("split", pa.int64()), ("from_between", pa.int8()), ("from_inside", pa.int8()), ("begins", pa.bool_()), ("first", pa.string())]
)


def _scan(functions: list) -> dict[tuple[str, int], tuple[int, int]]:
    """(state at its beginning, split in which the record at its beginning began) of every split."""
    out, file, state, owner = {}, None, BETWEEN, 0
    for r in functions:  # sorted by file and split
        if r["file"] != file:
            file, state, owner = r["file"], BETWEEN, r["split"]
        out[file, r["split"]] = (state, owner if state == INSIDE else r["split"])
        if state == BETWEEN or r["begins"]:
            owner = r["split"]
        state = r["from_between"] if state == BETWEEN else r["from_inside"]
    return out


def _records(entries: dict[tuple[str, int], tuple[int, int]], windows: set[str], fragments: bool):
    """Whole records, or the pieces of those that cross a border (of ``owner``, in the order of ``split``)."""

    def work(batches):
        at, held, state, owner, whole, skip = None, [], BETWEEN, 0, True, False
        out: list[tuple] = []

        def emit(ended: bool) -> None:
            nonlocal skip
            if skip:  # the header
                skip = not ended
            elif (whole and ended) != fragments:
                out.append((at[0], owner, at[1], "\n".join(held)))
            held.clear()

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("file", "split", "line", "from_between", "from_inside")]
            for file, split, line, *after in zip(*columns):
                if (file, split) != at:
                    if held:
                        emit(False)
                    at = (file, split)
                    if at not in entries:
                        raise RuntimeError(f"{file} was split in another way before: {_PIN} or the file has changed since it was first read")
                    state, owner = entries[at]
                    whole, skip = state == BETWEEN, split == 0
                held.append(line[:-1] if file in windows and line.endswith("\r") else line)
                state = after[state]
                if state == BETWEEN:
                    emit(True)
                    owner, whole = split, True
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PIECE.types)], schema=_PIECE)
                out.clear()
        if held:
            emit(False)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PIECE.types)], schema=_PIECE)

    return work


_PIECE = pa.schema([("file", pa.string()), ("owner", pa.int64()), ("split", pa.int64()), ("record", pa.string())])


def csv_records(spark: SparkSession, path: str | list[str], names: list[str]) -> DataFrame:
    """One row for each record behind the header, its text in ``record``.

    A file of many splits is read by many tasks.  A header other than ``names`` is an
    error.  Line ends may be ``\\n`` or ``\\r\\n``, by the header's; quoted ones become ``\\n``.
    """
    # The same files have to be split in the same way in each pass, also if executors come or go.
    if spark.conf.get(_PIN, None) is None:
        spark.conf.set(_PIN, str(spark.sparkContext.defaultParallelism))
    lines = _lines(spark, path)
    schema = "file string, split bigint, from_between tinyint, from_inside tinyint, begins boolean, first string"
    # One row for each split, so a millionth of the data.
    functions = lines.mapInArrow(_split_functions, schema).orderBy("file", "split").collect()
    for r in functions:
        if r["first"] is not None:
            found = next(csv.reader([r["first"].removeprefix("﻿").rstrip("\r")]), [])
            if [n.lower() for n in found] != [n.lower() for n in names]:
                raise ValueError(f"the header of {r['file']} is {found}, not {names}")
    entries = _scan(functions)
    windows = {r["file"] for r in functions if r["first"] is not None and r["first"].endswith("\r")}
    kind = "file string, owner bigint, split bigint, record string"
    whole = lines.mapInArrow(_records(entries, windows, fragments=False), kind).select("record")
    if all(state == BETWEEN for state, _ in entries.values()):
        crossing = None  # nothing is inside quotes at any border
    else:
        pieces = lines.mapInArrow(_records(entries, windows, fragments=True), kind)
        joined = pieces.groupBy("file", "owner").agg(F.array_sort(F.collect_list(F.struct("split", "record"))).alias("pieces"))
        crossing = materialise(joined.select(F.array_join(F.col("pieces.record"), "\n").alias("record")), "csv-crossing")
    records = whole if crossing is None else whole.unionByName(crossing)
    return records.where("record <> ''")


def read_split_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """The table of ``schema`` in CSV files with a header; quotes as in RFC 4180."""
    records = csv_records(spark, path, schema.fieldNames())
    row = F.from_csv("record", schema.simpleString(), {"quote": '"', "escape": '"', "multiLine": "true"})
    return records.select(row.alias("row")).select("row.*")
