"""Driver contract: entry() runs, every query matches its SQL twin (sf0.001)."""

import os

import pytest

import __spark_entry__ as E
from histmart.plans import ORACLE, QUERIES
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"o_orderpriority", "line_count", "revenue", "customers"}
    assert len(df.collect()) == 5


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    drows, dcols = rel.fetchall(), rel.columns
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(srows, df.columns) == digest(drows, dcols)
