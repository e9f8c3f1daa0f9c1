"""The correctness gate in miniature: registered queries vs their DuckDB
statements on sf0.001 (row count, columns, order-insensitive values)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from conftest import SF001  # noqa: E402
from oracle_check import TABLES, digest  # noqa: E402

from citegrid.plans.catalog import REGISTRY, TRAINED  # noqa: E402

NAMES = sorted(set(REGISTRY) - TRAINED)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF001)
    s_cols, s_rows = df.columns, [tuple(r) for r in df.collect()]
    res = con.sql(entry.oracle_sql()[name])
    d_cols, d_rows = res.columns, res.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert digest(s_cols, s_rows)[0] == digest(d_cols, d_rows)[0]
