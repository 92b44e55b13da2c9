"""Every registered query against its SQL oracle on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from dimwright.plans.catalog import ORACLES, QUERIES
from scripts.check_oracles import TABLES, rows_of

from support import SF001


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF001}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["tier", "active_count", "avg_amount", "total_amount"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF001)
    got = df.collect()
    r = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(r.columns)
    assert rows_of(df.columns, [tuple(x) for x in got]) == rows_of(r.columns, r.fetchall())
