"""Reading and writing review tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from marquee.schema import REVIEW_SCHEMA
from marquee.sources.split_csv import read_split_csv


def read_reviews(
    spark: SparkSession,
    path: str | list[str],
    fmt: str | None = None,
    schema: StructType = REVIEW_SCHEMA,
    columns: Sequence[str] | None = None,
    limit: int | None = None,
    order_by: Sequence[str] | None = None,
) -> DataFrame:
    """Read a review table from CSV, JSON lines or Parquet.

    ``columns`` prunes the scan.  ``limit`` keeps the first rows by
    ``order_by``, which must be given with it: files have no row order that
    survives a distributed read.
    """
    fmt = fmt or _format_of(path)
    reader = spark.read.schema(schema)
    if fmt == "csv":
        # Quoted review texts hold line breaks and doubled quotes, and one file may be very large.
        df = read_split_csv(spark, path, schema)
    elif fmt == "json":
        df = reader.json(path)
    elif fmt == "parquet":
        # The file's own types are read and cast: ratings may be stored as ints.
        stored = spark.read.parquet(*([path] if isinstance(path, str) else path))
        df = stored.select(
            *[stored[f.name].cast(f.dataType).alias(f.name) for f in schema if f.name in stored.columns]
        )
    else:
        raise ValueError(f"unknown format: {fmt}")
    if columns is not None:
        df = df.select(*columns)
    if limit is not None:
        if not order_by:
            raise ValueError("limit needs order_by: a row limit without an order is not repeatable")
        df = df.orderBy(*order_by).limit(limit)
    return df


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "errorifexists",
    partition_by: Sequence[str] = (),
) -> None:
    """Write as Parquet, CSV (with header) or JSON lines, one file per task."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.csv(path, header=True, quote='"', escape='"')
    elif fmt == "json":
        writer.json(path, ignoreNullFields=False)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown format: {fmt}")


def _format_of(path: str | list[str]) -> str:
    first = path if isinstance(path, str) else path[0]
    for fmt in ("csv", "json", "parquet"):
        if first.rstrip("/").endswith("." + fmt):
            return fmt
    return "parquet"
