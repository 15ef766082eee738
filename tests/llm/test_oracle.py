"""Queries that SQL can express, on whole tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages", "labels", "embeddings", "conversations"):
        duck.execute(f"create view {table} as select * from '{SF_DIR}/{table}.parquet'")
    expected = duck.sql(ORACLES[name]).to_arrow_table()
    got = QUERIES[name](spark, SF_DIR).toArrow().select(expected.column_names)
    assert [str(t) for t in got.schema.types] == [str(t) for t in expected.schema.types]
    rows = lambda t: sorted(map(str, (tuple(r.values()) for r in t.to_pylist())))
    assert rows(got) == rows(expected)
