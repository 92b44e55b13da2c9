"""The queries that SQL can express, against their SQL."""

import duckdb
import pytest

from dimwright.llm.catalog import ORACLES, QUERIES

PATH = "/root/testdata/sf0.01"


def rows(columns, values):
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([None if v[i] is None else v[i] for i in at]) for v in values)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{PATH}/{t}.parquet'")
    df = QUERIES[name](spark, PATH)
    want = con.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(want.columns, want.fetchall())


def test_all_are_registered():
    import __spark_entry__ as entry
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
