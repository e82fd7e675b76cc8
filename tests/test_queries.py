"""Registered queries against their DuckDB oracles (the external gate's
comparison), at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tickline.plans import catalog
from tools.check_oracle import TABLES, close, rows

SF = "/root/testdata/sf0.001"
#: The queries of the text operators have their own tests (tests/llm).
NAMES = sorted(catalog.ORACLES)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(E.oracle_sql()) <= set(E.queries()) and set(catalog.QUERIES) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "s1_vol_pnl" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = catalog.QUERIES[name](spark, SF).toPandas()
    want = con.sql(catalog.ORACLES[name]).df()
    gc, gr = rows(got)
    wc, wr = rows(want)
    assert gc == wc
    assert gr == wr or close(gr, wr)
