"""The registered queries: shapes, and those with SQL against it."""

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as driver
from talkgrain.llm import queries as llm

COLUMNS = {
    "op1_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op2_packing": ["doc_id", "piece", "n_tokens", "bin_id", "bin_offset"],
    "op3_quality": [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    ],
    "op4_decontamination": [
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
    ],
    "op5_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_simhash": ["doc_id", "fingerprint", "component_id"],
    "op7_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op8_token_ids": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op9_quality_model": [
        "doc_id", "lang", "n_tokens", "perplexity", "threshold", "alarm", "alarm_threshold", "kept",
    ],
    "op10_substrings": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op11_mixture": [
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
    ],
    "op12_interactions": [
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
        "good_lost", "toxic_lost", "shapley",
    ],
    "op13_resample": ["doc_id", "n_features", "weight", "score", "rank"],
}


def test_all_are_registered():
    assert set(COLUMNS) == set(llm.queries())
    assert {*COLUMNS, "pipeline"} <= set(driver.queries())


@pytest.mark.parametrize("name", list(COLUMNS))
def test_a_query_has_its_columns_and_a_row_per_document(spark, name):
    result = llm.queries()[name](spark, SF_DIR)
    assert result.columns[: len(COLUMNS[name])] == COLUMNS[name]
    if "doc_id" in COLUMNS[name]:
        assert result.select("doc_id").distinct().count() == 1000


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    result = llm.queries()[name](spark, SF_DIR)
    db = duckdb.connect()
    for table in ("documents", "benchmark", "labels"):
        db.execute(f"CREATE VIEW {table} AS FROM read_parquet('{SF_DIR}/{table}.parquet')")
    expected = db.execute(llm.oracle_sql()[name])
    assert [c[0] for c in expected.description] == result.columns
    types = {"BIGINT": "bigint", "VARCHAR": "string", "BOOLEAN": "boolean", "INTEGER": "int"}
    assert [types[str(c[1])] for c in expected.description] == [t for _, t in result.dtypes]
    assert sorted(tuple(r) for r in result.collect()) == sorted(expected.fetchall())
