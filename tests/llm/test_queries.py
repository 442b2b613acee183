from __future__ import annotations

import pytest

from tallymark.llm.queries import ORACLES, QUERIES

from tests.oracle import TABLES, compare, connect

FOLDER = str(TABLES / "sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name]) == ""


COLUMNS = {
    "op3_toxicity": ["doc_id", "held_out", "score", "predicted", "evidence"],
    "op4_token_output": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op6_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op8_quality": ["doc_id", "held_out", "score", "predicted"],
    "op10_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op1_minhash": ["doc_id", "class_id", "kept"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns_and_a_row_per_document(spark, name):
    found = QUERIES[name](spark, FOLDER)
    assert found.columns == COLUMNS[name]
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert found.select("doc_id").distinct().count() == documents
    if name != "op10_packing":
        assert found.count() == documents
