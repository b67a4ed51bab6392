"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for.  Shuffle partitions are left to the
# cluster: AQE merges small ones and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the checkpoint folder, or one beside the session's tables."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return named.rstrip("/") if named else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, the files of a job's shuffles go when the job ends, not when the driver's collector finds them."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def _file(spark: SparkSession, path: str):
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    return file, file.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, path: str) -> None:
    folder, files = _file(spark, path)
    files.delete(folder, True)
    if path in STORED:
        STORED.remove(path)


# Paths of the stored tables that are still there, oldest first.
STORED: list[str] = []


def release_paths(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables by path; those already gone are passed over."""
    for path in paths:
        _remove(spark, path)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, for files that live as long as the session."""
    path = f"{shared_dir(spark)}/marquee/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    folder, files = _file(spark, path)
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where one result feeds several jobs (model fits).  A written table
    outlives lost executors, cuts the lineage and gives the next plan real
    size statistics.  It lives as long as the session, if nobody releases it.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, name) + "/table"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    STORED.append(path)
    stored.stored_at = path
    return stored


def release(*tables: DataFrame) -> None:
    """Delete tables that ``materialise`` has stored and nothing will read again."""
    for table in tables:
        _remove(table.sparkSession, table.stored_at)
