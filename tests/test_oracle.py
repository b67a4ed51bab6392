"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from catalog.oracle import oracle
from catalog.queries import QUERIES as OWN
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
# The library's own; optional packages test theirs.
QUERIES = {name: query for name, query in entry.queries().items() if name in OWN}
ORACLE = oracle()
# Fits on a few dozen rows take many optimiser jobs: run where rows are many, and tested in test_models.
FITTED = {"score_lr", "score_svm", "score_corpus", "model_matrix"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(set(ORACLE) - FITTED))
def test_same_rows_as_sql(spark, con, name):
    _, problems = compare(spark, con, SF_DIR, name, QUERIES[name], ORACLE[name])
    assert not problems


def test_entry_gives_rows(spark):
    assert 0 < entry.entry(spark).count() <= 10
