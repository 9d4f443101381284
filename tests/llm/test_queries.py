"""The registered queries against their SQL, and their columns against what they promise."""

import duckdb
import pytest

import __spark_entry__
from stationlens.llm import queries

COLUMNS = {
    "op2_minhash": "doc_id n_shingles component_id kept",
    "op3_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op4_recompression": "doc_id n_words n_removed kept_sha256",
    "op5_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op6_langid": "doc_id held_out lang_pred score rejected",
    "op7_spotsigs": "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next",
    "op9_html": "page_id url text n_chars",
    "op10_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
}


def plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, sf, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    found = __spark_entry__.queries()[name](spark, sf)
    expected = con.execute(__spark_entry__.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    assert sorted(names) == sorted(found.columns)
    assert sorted(tuple(plain(r[n]) for n in names) for r in found.collect()) == sorted(tuple(map(plain, r)) for r in expected.fetchall())


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf, name):
    found = __spark_entry__.queries()[name](spark, sf)
    assert found.columns == COLUMNS[name].split()
    rows = found.count()
    table = spark.read.parquet(f"{sf}/{'pages' if name == 'op9_html' else 'documents'}.parquet").count()
    assert rows >= table if name == "op5_packing" else rows == table


def test_each_operator_has_a_query():
    names = list(__spark_entry__.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
