"""The registered queries against their DuckDB statements, on the smallest tables."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from citegrid.llm.queries import REGISTRY, STATEMENTS  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_matches_statement(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    df = REGISTRY[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    res = con.sql(STATEMENTS[name])
    columns, want = res.columns, res.fetchall()
    assert sorted(df.columns) == sorted(columns) and len(rows) == len(want)
    assert digest(df.columns, rows)[0] == digest(columns, want)[0]


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x[2].isdigit()}
    assert "pipeline" in names and set(STATEMENTS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name,columns", [
    ("op2_bin_packing", {"doc_id", "piece", "words", "bin_id"}),
    ("op4_token_files", {"doc_id", "start", "n_tokens", "ids_crc32"}),
    ("op5_language_id", {"doc_id", "held_out", "lang_pred", "score"}),
    ("op6_fingerprints", {"doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"}),
    ("op7_secret_scan", {"doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"}),
    ("op9_toxicity", {"doc_id", "held_out", "score", "predicted"})])
def test_whole_table_and_columns(spark, name, columns):
    df = REGISTRY[name](spark, SF001)
    assert columns <= set(df.columns)
    n = spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert df.select("doc_id").distinct().count() == n
