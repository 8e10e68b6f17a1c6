"""Every query with SQL gives the rows of DuckDB on the smallest tables; the others run and have rows."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from massquarry import plans

DATA = os.environ.get("MASSQUARRY_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(DATA):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return c


def norm(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    return float(f"{x:.9g}") if isinstance(x, (int, float)) else str(x)


@pytest.mark.parametrize("name", sorted(plans.QUERIES))
def test_query(spark, db, name):
    df = plans.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(x) for x in r) for r in df.select(*cols).collect())
    if name not in plans.ORACLE:
        assert df.columns
        return
    r = db.sql(plans.ORACLE[name])
    assert sorted(r.columns) == cols
    at = [r.columns.index(c) for c in cols]
    want = Counter(tuple(norm(row[i]) for i in at) for row in r.fetchall())
    assert got == want


def test_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
