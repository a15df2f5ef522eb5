"""Every catalogued query against its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from podelta.oracle import ORACLE as SQL
from podelta.plans.catalog import QUERIES as CATALOG
from tests.oracle_compare import canon_rows, duck

SF = "/root/testdata/sf0.001"
QUERIES = dict(CATALOG)
ORACLE = dict(SQL)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    s_cols, s_rows = canon_rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(ORACLE[name])
    d_cols, d_rows = canon_rows([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows, columns = df.collect(), df.columns
    again = E.entry(spark)
    assert rows and columns == again.columns
    assert sorted(map(str, rows)) == sorted(map(str, again.collect()))
