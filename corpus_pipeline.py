"""Prepares a training corpus from ``documents``: a row of operators, each on what its predecessor kept.

toxicity       documents that the network rejects go
ngram_dedup    one document of each group of near-duplicates stays (five words, similarity 0.8)
personal_data  spans become their kind in angle brackets
packing        what is left, as token pieces with their place in a sequence

Every stage keeps rows whose doc_id or text is null; a row that is repeated as a
whole stays once.  A stage's result has to be written before the next stage is
called, as ``run`` does: the tables it was made from go then.  In the first
stage texts travel to the Python workers in batches of ``TEXTS`` rows; the second
takes the session's own setting for that back.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee import session
from marquee.llm import jaccard_join, packing, pii, toxicity
from marquee.llm.texts import table


TEXTS = 256
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def after_previous(stage):
    """Lets go of the tables that the stage before has stored: its result has been written by now."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        session.release_paths(spark, _left.pop(spark.sparkContext.applicationId, []))
        mark = len(session.STORED)
        out = stage(spark, docs, sf_dir)
        _left[spark.sparkContext.applicationId] = session.STORED[mark:]
        return out

    return run_stage


_left: dict[str, list[str]] = {}


@after_previous
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    spark.conf.set(BATCH, str(TEXTS))
    net = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~toxicity.held_out(F.col("doc_id")))
    return toxicity.filter_toxic(docs, net)


@after_previous
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each component stays, with one text."""
    spark.conf.unset(BATCH)
    return jaccard_join.first_of_components(docs, size=5, num=80, den=100)


@after_previous
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


@after_previous
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_dedup", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("packing", pack),
]
ORACLE_SQL = None  # a trained network and a tokenizer are no SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = session.materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
