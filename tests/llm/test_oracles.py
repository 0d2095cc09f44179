"""Queries with SQL against DuckDB on the test tables."""

import os
from collections import Counter

import duckdb
import pytest

from starloom.llm.oracles import ORACLES
from starloom.llm.queries import REGISTRY

SF_DIR = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    wanted = duck.sql(ORACLES[name])
    found = REGISTRY[name](spark, SF_DIR).select(*wanted.columns)
    assert Counter(map(tuple, found.collect())) == Counter(wanted.fetchall())
