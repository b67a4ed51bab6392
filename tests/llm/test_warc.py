"""Archives written, indexed and read back."""

import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from marquee.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, file string, salt int, id string"
LONG = "<p>ünïcode</p>" * 100


def pages():
    rng = random.Random(5)
    hosts = ["www.example.net", "example.net", "EXAMPLE.org", "a.b.example.org", "net"]
    rows = [(i, f"http://{rng.choice(hosts)}/p/{i % 37}?q={i % 3}", "".join(rng.choices("abc é<>", k=rng.randrange(0, 1500)))) for i in range(120)]
    rows += [(200 + i, "http://hot.example.com/", LONG) for i in range(40)]
    rows += [(300, None, LONG), (301, None, None), (302, "", ""), (303, "no host\r\nline", "x" * 999), (304, "http://tab\there/\u0000é", "x" * 999),
             (305, "http://x/", "y" * 1000), (306, "http://x/", "y" * 1000), (306, "http://x/", "y" * 1000), (None, "http://x/", "y" * 1000),
             (None, "http://null/", "z" * 2000), (None, "http://null/", "z" * 2000), (307, "http://big/", "long " * 400_000)]
    return [(*r, "own", "own", 3, "own") for r in rows]


def expected(rows):
    keeper = {}
    for key, _, html, *_ in rows:
        if len((html or "").encode()) >= 1000 and key is not None:
            keeper[html] = max(key, keeper.get(html, key))
    out = []
    for key, url, html, *_ in rows:
        raw = (html or "").encode()
        again = html in keeper and keeper[html] != key
        out.append((key, url, "revisit" if again else "response", keeper[html] if again else None, len(raw), hashlib.sha1(raw).hexdigest()))
    return sorted(out, key=str)


def rows_of(records):
    def number(x):
        return None if x is None else int(x)

    got = [
        (number(r["key"]), r["url"], r["record_type"], number(r["refers_to"]), r["payload_bytes"], r["payload_digest"]) for r in records.collect()
    ]
    return sorted(got, key=str)


@pytest.fixture(scope="module")
def archive(spark):
    df = spark.createDataFrame(pages(), SCHEMA).repartition(5)
    folder, captures = warc.write_archives(df)
    return df, folder, captures, warc.build_index(captures, block_lines=7)


def test_every_row_comes_back_through_the_index(archive):
    df, folder, _, index = archive
    records = warc.read_records(folder, warc.look_up(index, df.select("url")))
    assert rows_of(records) == expected(pages())
    full = {(r["key"], r["url"], r["payload_digest"]): bytes(r["payload"] or b"") for r in warc.with_payloads(records).collect()}
    for key, url, html, *_ in pages():
        raw = (html or "").encode()
        assert full[(None if key is None else str(key), url, hashlib.sha1(raw).hexdigest())] == raw


def test_some_urls_and_prefixes(spark, archive):
    _, folder, _, index = archive
    ask = spark.createDataFrame([("http://hot.example.com/",), ("http://HOT.example.com/",), ("http://absent/",), (None,)], "url string")
    found = warc.look_up(index, ask)
    assert sorted(int(r["key"]) for r in found.collect()) == [*range(200, 240), 300, 301, 302]
    under = warc.look_up(index, spark.createDataFrame([("http://example.org",), ("http://b.example.org",)], "url string"), prefix=True)
    want = [k for k, u, *_ in pages() if u and u.lower().split("/")[2:3] in (["example.org"], ["a.b.example.org"])]
    assert sorted(int(r["key"]) for r in under.collect()) == want
    path = warc.look_up(index, spark.createDataFrame([("http://net/p/1",)], "url string"), prefix=True)
    assert {r["url"] for r in path.collect()} == {u for _, u, *_ in pages() if u and u.startswith("http://net/p/1")}


def test_only_blocks_that_can_hold_the_key_are_read(archive):
    _, _, _, index = archive
    shard = max(index.shards.collect(), key=lambda r: r["blocks"])
    files, path = warc._folder(index.folder)
    one = warc._Shard(files, path, shard["shard"])
    assert len(one.blocks) > 3
    read = []
    unpack = one.block
    one.block = lambda number: (read.append(number), unpack(number))
    last = one.first[-1]
    assert any(r[0] == last for rows in one.find(last, last + "\0") for r in rows)
    assert len(read) <= len([f for f in one.first if f == last]) + 1
    assert list(one.find(shard["high"] + "\0", shard["high"] + "\1")) == []


def test_archives_are_plain_gzip_members(archive):
    _, folder, captures, _ = archive
    files, path = warc._folder(folder)
    for name in {r["file"] for r in captures.collect()}:
        with files.open_input_file(f"{path}/{name}") as file:
            raw = gzip.decompress(file.read())
        own = captures.where(F.col("file") == name).count()
        assert raw.startswith(b"WARC/1.1\r\n") and raw.count(b"WARC-Record-ID: <urn:") == own


def test_damage_is_noticed():
    digest = hashlib.sha1(b"abc").hexdigest()
    assert warc.parse_record(warc.record("1", "u", memoryview(b"abc"), digest, "response", None)).payload == b"abc"
    with pytest.raises(ValueError):
        warc.parse_record(warc.record("1", "u", memoryview(b"abd"), digest, "response", None))


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    folder, captures = warc.write_archives(none)
    index = warc.build_index(captures)
    assert warc.look_up(index, none).collect() == [] and warc.read_records(folder, captures).collect() == []
    assert warc.look_up(index, spark.createDataFrame([("http://a/",)], "url string")).collect() == []
