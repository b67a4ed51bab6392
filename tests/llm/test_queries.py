"""The registered queries of the package: SQL where there is some, columns by contract."""

import pytest

import __spark_entry__ as entry
from marquee.llm.queries import ORACLE, QUERIES
from tests.compare import compare, duck

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_byte_bpe": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256 n_bytes"),
    "op4_html_extraction": ("pages", "page_id url text n_chars"),
    "op5_token_counts": ("documents", "doc_id n_bytes n_tokens over_limit"),
    "op6_ngram_jaccard_join": ("documents", "doc_id n_shingles component_id"),
    "op8_personal_data": ("documents", "doc_id n_email n_ip n_card n_phone base_sha256 spans"),
    "op9_toxicity": ("documents", "doc_id held_out score predicted"),
    "op11_fill_in_middle": ("documents", "doc_id n form prefix_chars middle_chars output_sha256 restored_sha256"),
    "op13_warc": ("pages", "page_id payload_bytes payload_digest record_type refers_to"),
}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    _, problems = compare(spark, duck(SF_DIR), SF_DIR, name, QUERIES[name], ORACLE[name])
    assert not problems


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_for_each_input_row(spark, name):
    table, columns = COLUMNS[name]
    found = QUERIES[name](spark, SF_DIR)
    assert found.columns == columns.split()
    assert found.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
