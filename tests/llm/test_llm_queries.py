"""The registered queries of this package: names, SQL twins and columns."""

import duckdb
import pytest

import __spark_entry__ as entry
from millrace.llm import queries
from millrace.tables import TABLES
from scripts.check import rows_of

COLUMNS = {
    "op1_pack": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op2_language_id": "doc_id held_out lang_pred score",
    "op3_quality": "doc_id held_out score predicted",
    "op4_fingerprints": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op5_top_products": "query_id rank vec_id score",
    "op6_mix": "doc_id",
    "op7_simhash_groups": "doc_id fingerprint component_id",
    "op8_secret_scan": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op9_main_text": "page_id url text n_chars",
    "op10_chat": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op11_token_codes": "doc_id start n_tokens ids_crc32",
    "op12_periodic_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
    "op13_whitening": "vec_id component n deviation whitened explained identity_error",
}


def test_all_are_registered():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, sf, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    cursor = db.execute(queries.SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


@pytest.mark.parametrize("name", sorted(set(COLUMNS) - set(queries.SQL)))
def test_every_row_is_answered(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    key = df.columns[0]
    source = {"page_id": "pages", "conv_id": "conversations", "vec_id": "embeddings"}.get(key, "documents")
    given = {r[0] for r in spark.read.parquet(f"{sf}/{source}.parquet").select(key).distinct().collect()}
    got = [r[0] for r in df.select(key).collect()]
    assert set(got) - {-1} == given
    if name not in ("op1_pack", "op13_whitening"):
        assert len(got) == len(set(got))
