"""Every registered query against its oracle, over the whole given tables."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from sluiceway.catalogue import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def comparable(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


# What no query may need: rows in Python, all pairs, or a cut.
UNWANTED = ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "InArrow", "CollectLimit", "LocalLimit")


def normalized(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(comparable(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = oracle.execute(ORACLES[name])
    expected_names = [d[0] for d in expected.description]
    expected_rows = expected.fetchall()
    assert sorted(result.columns) == sorted(expected_names)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNWANTED if node in plan]
    assert normalized(result.columns, result.collect()) == normalized(expected_names, expected_rows)
