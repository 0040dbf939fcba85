"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

from searchshift.plans.catalog import load_all
from searchshift.plans.fixtures import TABLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables here")


@pytest.fixture(scope="module")
def oracle():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return repr(round(v, 9)) if isinstance(v, float) else str(v)

    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", list(load_all()))
def test_query(spark, oracle, name):
    query = load_all()[name]
    df = query.run(spark, FOLDER)
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    assert query.oracle, "every query has SQL to compare with"
    result = oracle.execute(query.oracle)
    assert got == comparable([d[0] for d in result.description], result.fetchall())
    assert got[1], "a query without rows checks nothing"


def test_contract(spark):
    import __spark_entry__ as contract
    # the corpus queries come on top, where they are present
    assert set(load_all()) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert set(contract.queries()) - set(load_all()) == set(contract.LLM_QUERIES)
    assert contract.entry(spark).count() > 0
