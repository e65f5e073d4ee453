"""The correctness gate as a test: every registered query against its DuckDB
oracle on the smallest driver tables (rows-only where no oracle exists)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, norm  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    rows = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert rows, f"{name} returned no rows"
        return
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert rows == want
