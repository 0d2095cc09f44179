"""Every query at sf0.01 against its SQL on DuckDB."""

import math
import os
from collections import Counter

import duckdb
import pytest

from workload.oracles import ORACLES
from workload.queries import REGISTRY

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def comparable(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    if isinstance(value, int) and not isinstance(value, bool):
        return float(value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(comparable(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_sql(spark, duck, name):
    df = REGISTRY[name](spark, SF_DIR)
    found = bag(df.columns, df.collect())
    relation = duck.sql(ORACLES[name])
    wanted = bag(relation.columns, relation.fetchall())
    assert sorted(df.columns) == sorted(relation.columns)
    assert wanted, "the SQL returns no rows, so it checks nothing"
    extra, lacking = found - wanted, wanted - found
    assert not extra and not lacking, (
        f"{sum(extra.values())} extra, {sum(lacking.values())} lacking; "
        f"e.g. {list(extra)[:2]} against {list(lacking)[:2]}"
    )
