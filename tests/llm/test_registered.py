"""Every registered query as it is registered, over the smallest tables: rows, columns and types of its contract."""

import re

import pytest

from tallyforge.llm import queries

L, S, B, D = "bigint", "string", "boolean", "double"
#: The columns that each query returns at least.
COLUMNS = {
    "op1_language_id": {"doc_id": L, "held_out": B, "lang_pred": S, "score": D},
    "op2_line_dedup": {"doc_id": L, "kept_sha256": S},
    "op3_jaccard_join": {"doc_id": L, "n_shingles": L, "component_id": L},
    "op4_token_ids": {"doc_id": L, "start": L, "n_tokens": L, "ids_crc32": L},
    "op5_pii": {"doc_id": L, "n_email": L, "n_ip": L, "n_card": L, "n_phone": L, "base_sha256": S, "spans": S},
    "op6_byte_bpe": {"doc_id": L, "n_tokens": L, "ids_sha256": S, "decoded_sha256": S},
    "op7_fingerprint": {"doc_id": L, "n_chars": L, "edited_sha256": S, "fingerprint": S, "edited_fingerprint": S, "near_edited": D, "near_next": D},
    "op8_quality_rules": {"doc_id": L, "n_words": L, "word_chars": L, "n_symbols": L, "n_dup_lines": L, "n_repeat_words": L, "base_failed": B, "kept": B},
    "op9_token_counts": {"doc_id": L, "n_bytes": L, "n_tokens": L, "over_limit": B},
    "op10_mixing": {"doc_id": L},
    "op12_runs": {"doc_id": L, "n_runs": L, "start": L, "length": L, "period": L, "exponent_milli": L, "runs_sha256": S, "collapsed_sha256": S},
    "op13_exact_dedup": {"doc_id": L, "keep_id": L, "group_size": L, "kept": B, "text_sha256": S},
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_one_row_a_document(spark, sf, name):
    found = queries.queries()[name](spark, sf)
    types = dict(found.dtypes)
    assert {c: types.get(c) for c in COLUMNS[name]} == COLUMNS[name]
    ids = sorted(r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect())
    rows = found.collect()
    assert sorted(r["doc_id"] for r in rows) == ids
    never_null = [c for c in COLUMNS[name] if not (name == "op12_runs" and c in ("start", "length", "period", "exponent_milli"))]
    assert all(r[c] is not None for r in rows for c in never_null)
    for c in COLUMNS[name]:
        if c.endswith("sha256"):
            assert all(re.fullmatch("[0-9a-f]{64}", r[c]) for r in rows)
        if c in ("score", "near_edited", "near_next"):
            assert all(0 <= r[c] <= 1 for r in rows)


def test_all_are_known():
    assert set(COLUMNS) | {"op11_hard_negatives"} == set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    got = queries.queries()[name](spark, sf)
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == sorted(cursor.fetchall())
