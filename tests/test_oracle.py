"""Layer 2: every catalog query against its DuckDB oracle (sf0.001 here; the
driver runs the same comparison at sf0.01), plus a run of the rows-only keys."""

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

ORACLE = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()
HEAVY = {"flagship", "flagship_parity", "linreg_cv", "dtree_cv", "rforest_cv"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_a_callable():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 45


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    res = duck.sql(ORACLE[key])
    assert sorted(df.columns) == sorted(res.columns)
    _, got = digest(df.columns, [tuple(r) for r in df.collect()])
    _, want = digest(res.columns, res.fetchall())
    assert len(got) == len(want)
    assert got == want


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE) - HEAVY))
def test_rows_only_queries_run(spark, key):
    df = QUERIES[key](spark, SF_SMALL)
    assert df.count() > 0
