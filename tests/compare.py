"""Compare registered queries with their SQL: python -m tests.compare [sf] [name ...]"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(round(value, 6) + 0.0)
    return str(value)


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple("∅" if r[i] is None else canonical(r[i]) for i in order) for r in rows)


def kinds(columns, types):
    """Type families by column name, so that both engines can be compared."""
    family = {
        "string": "text", "varchar": "text", "int": "int", "integer": "int", "bigint": "bigint", "double": "double",
        "boolean": "bool", "hugeint": "hugeint",
    }
    return {c: family.get(t.lower(), t.lower()) for c, t in zip(columns, types)}


def compare(spark, con, sf_dir, name, query, sql):
    df = query(spark, sf_dir)
    spark_columns, spark_rows = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    types = [str(c[1]) for c in cursor.description]
    duck_columns, duck_rows = sorted_rows(names, cursor.fetchall())
    problems = []
    if spark_columns != duck_columns:
        problems.append(f"columns {spark_columns} != {duck_columns}")
    ours, theirs = kinds(df.columns, [t for _, t in df.dtypes]), kinds(names, types)
    off = {c: (ours.get(c), theirs.get(c)) for c in ours if ours.get(c) != theirs.get(c)}
    if off:
        problems.append(f"types {off}")
    if len(spark_rows) != len(duck_rows):
        problems.append(f"rows {len(spark_rows)} != {len(duck_rows)}")
    if spark_rows != duck_rows:
        a, b = set(spark_rows) - set(duck_rows), set(duck_rows) - set(spark_rows)
        problems.append(f"{len(a)} only in spark, {len(b)} only in sql; {str(sorted(a)[:1])[:700]} | {str(sorted(b)[:1])[:700]}")
    return len(spark_rows), problems


def main(argv):
    sf = argv[0] if argv else "sf0.01"
    sf_dir = f"/root/testdata/{sf}"
    spark, con = session(), duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    chosen = argv[1:] or list(queries)
    bad = []
    for name in chosen:
        begin = time.time()
        try:
            if name in oracle:
                n, problems = compare(spark, con, sf_dir, name, queries[name], oracle[name])
            else:
                n, problems = len(queries[name](spark, sf_dir).collect()), []
        except Exception as error:  # noqa: BLE001
            n, problems = -1, [f"{type(error).__name__}: {str(error)[:600]}"]
        mark = "ok  " if not problems else "FAIL"
        kind = "sql" if name in oracle else "rows"
        print(f"{mark} {name:28s} {kind:4s} rows={n:<8d} {time.time() - begin:6.2f}s", *problems, flush=True)
        if problems:
            bad.append(name)
    print(f"{len(chosen) - len(bad)} of {len(chosen)} fine", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
