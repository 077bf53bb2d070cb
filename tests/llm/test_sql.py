"""Queries that SQL can express, against their SQL."""

import os

import duckdb
import pytest

from offerweave.llm import queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{SF}/{f}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    names = sorted(df.columns)
    found = duck.execute(f"select {', '.join(names)} from ({queries.ORACLES[name]})")
    assert sorted(map(str, map(tuple, df.select(*names).collect()))) == sorted(map(str, found.fetchall()))
