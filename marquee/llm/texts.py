"""Reading the tables, walking over Arrow batches of texts in small steps, and what workers keep between tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_RANGE = 1 << 40
_MODEL: dict[tuple, object] = {}
STEP_CHARS = 1 << 20  # characters that one step of a batch holds before the next begins


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def hashed_sample(df: DataFrame, rows: float, total: int, *columns: str) -> DataFrame:
    """About ``rows`` of ``total`` rows, the same ones every time, by a hash of ``columns``.

    Every task keeps its share, so what the sample weighs does not grow with the tasks.
    """
    share = F.lit(min(1.0, rows / max(1, total)) * _RANGE)
    return df.where(F.pmod(F.xxhash64(F.lit(17), *columns), F.lit(_RANGE)) < share)


def steps(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) over a batch; a null text is an empty one.

    A step ends when it holds ``STEP_CHARS`` characters, so what a worker keeps
    at once follows from that and the longest text, not from the rows of a batch.
    """
    first, held, size = 0, [], 0
    texts = batch.column(column)
    for i in range(batch.num_rows):
        text = texts[i].as_py() or ""
        held.append(text)
        size += len(text)
        if size >= STEP_CHARS:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def forget_model() -> None:
    """Lets go of the model of an earlier stage, for one that has none."""
    if _MODEL:
        _MODEL.clear()
        pa.default_memory_pool().release_unused()


def only_model(make: Callable, *args):
    """``make(*args)``, kept until another one is asked for.

    Python workers go on from stage to stage; each keeps the model of its present stage alone.
    """
    if (make, *args) not in _MODEL:
        forget_model()
        made = make(*args)
        _MODEL.clear()  # of a model that another one was made of, too
        _MODEL[(make, *args)] = made
    return _MODEL[(make, *args)]
