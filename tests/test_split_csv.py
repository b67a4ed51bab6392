"""Multi-line CSV read in splits against Spark's own reader, which takes a file in one task."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from marquee.sources import split_csv
from marquee.sources.split_csv import quote_state, read_split_csv

SCHEMA = "a string, b int, c string"
SPLIT = "spark.sql.files.maxPartitionBytes"


def whole(spark, path):
    """The same file by one task."""
    return spark.read.schema(SCHEMA).csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@pytest.fixture
def split_bytes(spark):
    names = [SPLIT, "spark.sql.files.openCostInBytes"]
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


def splits_of(spark, path):
    """Different splits that hold the beginning of a line."""
    return split_csv._lines(spark, path).select("file", "split").distinct().count()


TRICKY = (
    'a,b,c\nplain,1,x\n"two\nlines",2,"with ""quotes"", a comma\nand\n\nblank lines"\n,,\n"",3,""\n5" disk,4,a"b"c\n'
    '"""start",5,"end"""\n"\n",6,"\n\n"\n"a,""\n"",b",7,","\nlast,8,"no line end\n at all"'
)


def test_a_border_at_every_byte(spark, split_bytes, tmp_path):
    path = str(tmp_path / "t.csv")
    (tmp_path / "t.csv").write_text(TRICKY)
    want = rows_of(whole(spark, path))
    assert len(want) == 9
    for size in (1, 2, 3, 5, 8, 13, 27, 60, 1000):
        split_bytes(size)
        assert rows_of(read_split_csv(spark, path, whole(spark, path).schema)) == want, size


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_random_files(spark, split_bytes, tmp_path, end):
    rng = random.Random(3)
    for number in range(3):
        with open(tmp_path / f"{number}.csv", "w", newline="", encoding="utf-8") as file:
            out = csv.writer(file, lineterminator=end)
            out.writerow(["a", "b", "c"])
            for i in range(rng.randrange(30, 80)):
                texts = ["".join(rng.choice(['"', ",", end, "é", "x", "y ", "€"]) for _ in range(rng.randrange(0, 30))) for _ in "ac"]
                out.writerow([texts[0], i, texts[1]])
    path = str(tmp_path)
    schema = whole(spark, path).schema
    want = rows_of(whole(spark, path))
    for size in (97, 500):
        split_bytes(size)
        assert splits_of(spark, path) > 10
        assert rows_of(read_split_csv(spark, path, schema)) == want


def test_many_tasks_read_one_file(spark, split_bytes, tmp_path):
    path = str(tmp_path / "big.csv")
    with open(path, "w") as file:
        file.write("a,b,c\n")
        for i in range(20_000):
            file.write(f'"text {i}\nof ""two"" lines",{i},x\n')
    split_bytes(1 << 16)
    table = read_split_csv(spark, path, whole(spark, path).schema)
    assert table.agg(F.count("*"), F.sum("b")).first() == (20_000, sum(range(20_000)))
    per_task = table.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) > 5 and max(r["count"] for r in per_task) < 5_000


def test_state_behind_a_line(spark):
    lines = ["", "a,b", '"', '""', '"a"', 'a"b', ',"', '"",', '"""', 'a""', '"a"b"', 'x,"y","z', '","', '"a,"",b']
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    for before in (0, 1):
        got = {r.line: r.s for r in df.select("line", quote_state(F.col("line"), before).alias("s")).collect()}
        for line in lines:
            inside, closed, field = before == 1, before == 0, before == 0  # a reader's state, letter by letter
            for ch in line:
                if inside:
                    inside, closed = ch != '"', ch == '"'
                else:
                    inside = ch == '"' and (field or closed)
                    closed = False
                field = ch == "," and not inside
            assert got[line] == int(inside), (before, line)


def test_headers_and_empty_files(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    (tmp_path / "only.csv").write_text("﻿A,b,C\n")
    assert read_split_csv(spark, str(tmp_path / "only.csv"), schema).collect() == []
    (tmp_path / "empty.csv").write_text("")
    assert read_split_csv(spark, str(tmp_path / "empty.csv"), schema).collect() == []
    (tmp_path / "other.csv").write_text("a,c,b\nx,1,y\n")
    with pytest.raises(ValueError, match="header"):
        read_split_csv(spark, str(tmp_path / "other.csv"), schema)
