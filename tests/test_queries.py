"""Every query over the smallest tables against its SQL in DuckDB."""

import os

import duckdb
import pytest

from seqloom.plans import catalogue

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(DIR):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DIR)
    columns = sorted(got.columns)
    want = duck.sql(catalogue.ORACLE[name])
    assert sorted(want.columns) == columns
    rows = lambda rs: sorted(map(str, rs))
    assert rows(tuple(r) for r in got.select(*columns).collect()) == rows(want.select(*columns).fetchall())
