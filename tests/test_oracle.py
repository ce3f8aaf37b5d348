"""Every registered query with oracle SQL matches DuckDB on the sf0.001 tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import _rows, duck_conn  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(E.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck_conn(SF)


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, con, key):
    df = E.queries()[key](spark, SF)
    sc, sr = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(E.oracle_sql()[key])
    dc, dr = _rows([d[0] for d in cur.description], cur.fetchall())
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_every_query_has_rows_or_oracle():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["City", "Crime Type", "Count"]
