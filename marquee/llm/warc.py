"""WARC archives with a two-level capture index.

Writing: each task appends records, every one a gzip member of its own, to archive
files with names of their own, and returns one row for each record with file,
offset and length.  That table is the manifest: what a lost or repeated task has
left behind is in no row of it and so is never read.

Index: captures are range-sorted by the url's key, its host labels from the right
and then the rest, and written as shards of compressed blocks of lines.  Beside
each shard lies its directory, the first key of every block; above them is one row
for each shard.  A look-up finds the shards of a key in the rows, binary-searches
the directory, and reads and unpacks only the blocks that can hold the key.

Records are then read by ranges of their archives, close ones together.

Equal payloads (one digest and length) are stored once: of those with at least
``min_revisit`` bytes that with the largest id is a response and the others are
revisits that refer to it.  Revisits keep the HTTP headers, so digest and length of
the full payload are with each record.

Inputs and results that need saying: a null html is an empty payload; a null url
has the empty key and no target header; line breaks in a url are percent-encoded in
the record and the index has the url as it is; a row without id revisits a row
with one but is never referred to; rows that repeat the largest id with an equal
payload are all responses, as a record does not revisit its own id; equal rows are
records of their own; an empty table makes no files and an empty index; further
columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.session import materialise, scratch_folder

ARCHIVE_BYTES = 1 << 30  # an archive is closed when it has grown to that
BLOCK_LINES = 1000  # captures in a block of the index
CHUNK_BITS = 26  # 64 MB of an archive are read by one task
GAP, TOGETHER = 1 << 16, 1 << 22  # records this near are read together, up to that many bytes
SALTS = 16  # parts of a group of equal payloads
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of their own
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ID = "urn:x-page:"


def url_key(url: Column) -> Column:
    """``http://www.example.net/a?b`` becomes ``net,example,www,)/a?b``; without a host the url itself, null is empty."""
    at = F.instr(url, "://")
    rest = url.substr(at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(",)"), rest.substr(F.length(host) + 1, F.length(url)))
    return F.coalesce(F.when(at > 0, key).otherwise(url), F.lit(""))


def _folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, and its path there; ``file:/x`` is also written with one slash by Hadoop."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path)


# --- records -------------------------------------------------------------------


def record(key: str | None, url: str | None, payload: memoryview, digest: str, kind: str, refers_to: str | None) -> bytes:
    """A record as a gzip member; a revisit keeps the headers of its response only."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else b"".join((http, payload))
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID + key if key is not None else uuid.uuid4().urn}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: {digest}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: <{_ID}{refers_to}>")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join((pack.compress("\r\n".join(head).encode()), pack.compress(block), pack.compress(b"\r\n\r\n"), pack.flush()))


@dataclass(frozen=True)
class Record:
    key: str | None
    url: str | None
    kind: str
    refers_to: str | None
    digest: str
    payload_bytes: int
    payload: bytes | None  # none in a revisit


def _headers(raw: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in raw.decode().split("\r\n")[1:])


def parse_record(member: bytes) -> Record:
    """A record from its gzip member; a payload that does not fit its length or digest is an error."""
    raw = zlib.decompress(member, 31)
    end = raw.index(b"\r\n\r\n")
    head = _headers(raw[:end])
    block = raw[end + 4 : end + 4 + int(head["Content-Length"])]
    end = block.index(b"\r\n\r\n")
    payload = block[end + 4 :]
    size = int(_headers(block[:end])["Content-Length"])
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = head["WARC-Type"]
    if kind != "revisit" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {head['WARC-Record-ID']} is damaged")

    def named(field: str) -> str | None:
        value = head.get(field, "<>")[1:-1]
        return value[len(_ID) :] if value.startswith(_ID) else None

    return Record(
        named("WARC-Record-ID"), head.get("WARC-Target-URI"), kind, named("WARC-Refers-To"), digest, size, None if kind == "revisit" else payload
    )


# --- writing -------------------------------------------------------------------

_CAPTURE = "key string, url_key string, url string, record_type string, file string, offset bigint, length bigint"


def _written(folder: str):
    def work(batches):
        files, path = _folder(folder)
        out, name, at = None, None, 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "url_key", "url", "digest", "record_type", "refers_to")]
            html, names, offsets, lengths = batch.column("html"), [], [], []
            for i, (key, _, url, digest, kind, refers_to) in enumerate(zip(*columns)):
                payload = html[i].as_buffer()
                member = record(key, url, memoryview(payload) if payload is not None else memoryview(b""), digest, kind, refers_to)
                if out is None or at >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{path}/{name}", compression=None)
                out.write(member)
                names.append(name)
                offsets.append(at)
                lengths.append(len(member))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("key", "url_key", "url", "record_type")],
                 pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                names=["key", "url_key", "url", "record_type", "file", "offset", "length"],
            )
        if out is not None:
            out.close()

    return work


def _kinds(pages: DataFrame, min_revisit: int) -> DataFrame:
    """``pages`` with digest, record_type and refers_to; only digests and ids are grouped."""
    hashed = pages.withColumns({"digest": F.sha1("html"), "n_bytes": F.octet_length("html").cast("long")})
    long = hashed.where(F.col("n_bytes") >= min_revisit)
    groups = long.groupBy("digest", "n_bytes").agg(F.max("id").alias("keeper"), F.count("*").alias("m"))
    groups = materialise(groups.where("m > 1 AND keeper IS NOT NULL").drop("m"), "warc-groups")
    # A group may hold a third of all pages: each of its parts meets a copy of the group's row.
    groups = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = hashed.withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int"))
    joined = salted.join(groups, ["digest", "n_bytes", "salt"], "left")
    again = F.col("keeper").isNotNull() & ~F.col("id").eqNullSafe(F.col("keeper"))
    return joined.select(
        F.col("id").cast("string").alias("key"), url_key(F.col("url")).alias("url_key"), "url", F.col("html").cast("binary").alias("html"), "digest",
        F.when(again, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(again, F.col("keeper").cast("string")).alias("refers_to"),
    )


def write_archives(
    pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html", min_revisit: int = 1000
) -> tuple[str, DataFrame]:
    """(folder of the archives, captures): one record of each row, and where it lies.

    Without ``folder`` a new one in the session's shared folder is taken.
    """
    folder = folder or scratch_folder(pages.sparkSession, "warc-archives")
    own = pages.select(F.col(key).alias("id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"))
    return folder, materialise(_kinds(own, min_revisit).mapInArrow(_written(folder), _CAPTURE), "warc-captures")


# --- index ---------------------------------------------------------------------

_LINE = ["url_key", "key", "url", "record_type", "file", "offset", "length"]


@dataclass(frozen=True)
class CaptureIndex:
    """``shards`` has one row for each shard: its name, first and last key."""

    folder: str
    shards: DataFrame


def _shards(folder: str, block_lines: int):
    def work(batches):
        files, path = _folder(folder)
        name, out, blocks, lines, at, low, high = uuid.uuid4().hex, None, [], [], 0, None, None

        def close_block():
            nonlocal at
            packed = zlib.compress("\n".join(lines).encode())
            out.write(packed)
            blocks.append((json.loads(lines[0])[0], at, len(packed)))
            at += len(packed)
            lines.clear()

        for batch in batches:
            for row in zip(*[batch.column(c).to_pylist() for c in _LINE]):
                if out is None:
                    low, out = row[0], files.open_output_stream(f"{path}/{name}.idx", compression=None)
                high = row[0]
                lines.append(json.dumps(row))
                if len(lines) == block_lines:
                    close_block()
        if out is None:
            return
        if lines:
            close_block()
        out.close()
        with files.open_output_stream(f"{path}/{name}.dir", compression=None) as directory:
            directory.write(json.dumps(blocks).encode())
        yield pa.RecordBatch.from_pydict({"shard": [name], "low": [low], "high": [high], "blocks": pa.array([len(blocks)], pa.int64())})

    return work


def build_index(captures: DataFrame, folder: str | None = None, block_lines: int = BLOCK_LINES) -> CaptureIndex:
    """Shards of sorted compressed blocks over ``captures``; a hot key runs over several."""
    folder = folder or scratch_folder(captures.sparkSession, "warc-index")
    by = ["url_key", "file", "offset"]
    ranged = captures.select(*_LINE).repartitionByRange(*by).sortWithinPartitions(*by)
    return CaptureIndex(folder, materialise(ranged.mapInArrow(_shards(folder, block_lines), "shard string, low string, high string, blocks bigint"), "warc-shards"))


class _Shard:
    """One shard, read by ranges; remembers the block it has unpacked last."""

    def __init__(self, files: fs.FileSystem, path: str, name: str):
        with files.open_input_file(f"{path}/{name}.dir") as directory:
            self.blocks = json.loads(directory.read())
        self.first = [b[0] for b in self.blocks]
        self.file = files.open_input_file(f"{path}/{name}.idx")
        self.number, self.rows, self.keys = None, [], []

    def block(self, number: int) -> None:
        if number != self.number:
            _, offset, length = self.blocks[number]
            raw = self.file.read_at(length, offset)
            self.rows = [json.loads(line) for line in zlib.decompress(raw).decode().split("\n")]
            self.keys, self.number = [r[0] for r in self.rows], number

    def find(self, low: str, high: str):
        """Lists of captures with low <= key < high, one for each block that has any."""
        number = max(0, bisect_left(self.first, low) - 1)  # the block before may end with the key
        while number < len(self.blocks) and self.first[number] < high:
            self.block(number)
            rows = self.rows[bisect_left(self.keys, low) : bisect_left(self.keys, high)]
            if rows:
                yield rows
            number += 1


def _looked_up(folder: str):
    def work(batches):
        files, path = _folder(folder)
        name, shard = None, None
        for batch in batches:
            for wanted, low, high in zip(*[batch.column(c).to_pylist() for c in ("shard", "low", "high")]):
                if wanted != name:
                    if shard is not None:
                        shard.file.close()
                    name, shard = wanted, _Shard(files, path, wanted)
                for rows in shard.find(low, high):
                    yield pa.RecordBatch.from_pydict(dict(zip(_LINE, map(list, zip(*rows)))), schema=_ARROW_LINE)

    return work


_ARROW_LINE = pa.schema([(c, pa.int64() if c in ("offset", "length") else pa.string()) for c in _LINE])


def look_up(index: CaptureIndex, urls: DataFrame, url: str = "url", prefix: bool = False) -> DataFrame:
    """The captures of each different url, as in ``write_archives``.

    With ``prefix`` a url stands for all that begin with it; one without a path
    (``http://example.net``) for its host and all subdomains.  Captures that
    several prefixes hold come once.
    """
    key = url_key(F.col(url))
    low = F.regexp_replace(key, r"\)$", "") if prefix else key
    high = F.concat(low, F.lit("\U0010ffff" if prefix else "\0"))
    asked = urls.select(low.alias("low"), high.alias("high")).distinct()
    # One row for each shard, so as many as the index has partitions.
    shards = index.shards.orderBy("low", "high").collect()
    if not shards:
        return index.shards.sparkSession.createDataFrame([], ", ".join(f"{c} {'bigint' if c in ('offset', 'length') else 'string'}" for c in _LINE))
    names = [s["shard"] for s in shards]
    lows, highs = [s["low"] for s in shards], [s["high"] for s in shards]

    def to_shards(batches):
        for batch in batches:
            rows, met = [], []
            for i, (low, high) in enumerate(zip(*[batch.column(c).to_pylist() for c in ("low", "high")])):
                for j in range(bisect_left(highs, low), bisect_left(lows, high)):
                    rows.append(i)
                    met.append(j)
            rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(met, pa.int32()), pa.array([names[j] for j in met], pa.string()), batch.column("low").take(rows), batch.column("high").take(rows)],
                names=["place", "shard", "low", "high"],
            )

    dealt = asked.mapInArrow(to_shards, "place int, shard string, low string, high string")
    dealt = materialise(dealt, "warc-asked").repartitionByRange("place", "low").sortWithinPartitions("place", "low")
    schema = ", ".join(f"{c} {'bigint' if c in ('offset', 'length') else 'string'}" for c in _LINE)
    found = dealt.mapInArrow(_looked_up(index.folder), schema)
    return found.dropDuplicates(["file", "offset"]) if prefix else found


# --- reading -------------------------------------------------------------------


def _runs(files: list[str], offsets: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """Runs of captures, sorted by file and offset, that are read at once."""
    runs, first = [], 0
    for i in range(1, len(files) + 1):
        if i == len(files) or files[i] != files[first] or offsets[i] - (offsets[i - 1] + lengths[i - 1]) > GAP or offsets[i] + lengths[i] - offsets[first] > TOGETHER:
            runs.append((first, i))
            first = i
    return runs


def _read(folder: str, payload: bool):
    def work(batches):
        system, path = _folder(folder)
        name, file = None, None
        for batch in batches:
            files, urls = batch.column("file").to_pylist(), batch.column("url").to_pylist()
            offsets, lengths = batch.column("offset").to_numpy(), batch.column("length").to_numpy()
            for first, last in _runs(files, offsets, lengths):
                if files[first] != name:
                    if file is not None:
                        file.close()
                    name, file = files[first], system.open_input_file(f"{path}/{files[first]}")
                begin = int(offsets[first])
                raw = file.read_at(int(offsets[last - 1] + lengths[last - 1]) - begin, begin)
                records = [parse_record(raw[offsets[i] - begin : offsets[i] - begin + lengths[i]]) for i in range(first, last)]
                columns = {
                    "key": [r.key for r in records], "url": urls[first:last], "record_type": [r.kind for r in records],
                    "refers_to": [r.refers_to for r in records], "payload_bytes": pa.array([r.payload_bytes for r in records], pa.int64()),
                    "payload_digest": [r.digest for r in records],
                }
                if payload:
                    columns["payload"] = pa.array([r.payload for r in records], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, pa.string()) if isinstance(v, list) else v for v in columns.values()], names=list(columns)
                )

    return work


def read_records(folder: str, captures: DataFrame, payload: bool = True) -> DataFrame:
    """(key, url, record_type, refers_to, payload_bytes, payload_digest[, payload]) of each capture, its payload checked.

    A task reads what is asked for in 64 MB of one archive, in its order.
    """
    dealt = captures.select("url", "file", "offset", "length").repartition("file", F.shiftright("offset", CHUNK_BITS))
    schema = "key string, url string, record_type string, refers_to string, payload_bytes bigint, payload_digest string"
    return dealt.sortWithinPartitions("file", "offset").mapInArrow(_read(folder, payload), schema + (", payload binary" if payload else ""))


def with_payloads(records: DataFrame) -> DataFrame:
    """``records`` with each revisit's payload taken from the response it refers to.

    Responses that many revisits share are copied for each of ``SALTS`` parts of them.
    """
    wanted = records.where("record_type = 'revisit'").groupBy(F.col("refers_to").alias("of"), F.col("payload_digest").alias("digest")).count()
    shared = records.where("record_type = 'response'").select(F.col("key").alias("of"), F.col("payload_digest").alias("digest"), F.col("payload").alias("full"))
    shared = shared.join(wanted.drop("count"), ["of", "digest"]).dropDuplicates(["of", "digest"])
    shared = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = records.withColumn("salt", F.pmod(F.xxhash64("key", "url"), F.lit(SALTS)).cast("int"))
    same = (own["refers_to"] == shared["of"]) & (own["payload_digest"] == shared["digest"]) & (own["salt"] == shared["salt"])
    return own.join(shared, same, "left").select(
        *[own[c] for c in records.columns if c != "payload"], F.coalesce(own["payload"], shared["full"]).alias("payload")
    )
