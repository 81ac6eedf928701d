"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import duckdb
import pytest

import __spark_entry__ as E
from spendstar.plans.queries import QUERIES

from .conftest import SF001

TABLES = ["lineitem"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(r[i]) if isinstance(r[i], float) else r[i] for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("key", sorted(set(E.oracle_sql()) & set(QUERIES)))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF001)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    want = [tuple(w[ocols.index(c)] for c in df.columns) for w in want]
    assert _norm(got, df.columns) == _norm(want, df.columns)


def test_entry_and_rows_only(spark):
    assert E.entry(spark).count() == 6
    for key in set(QUERIES) - set(E.oracle_sql()):
        assert E.queries()[key](spark, SF001).count() >= 1
