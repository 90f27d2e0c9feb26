"""Every registered query against its SQL counterpart, and none with a forbidden plan."""

from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, Decimal)):
        return round(float(value), 9)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    got = Counter(tuple(plain(row[c]) for c in columns) for row in result.collect())
    assert got
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in ORACLE:
        return
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(plain(row[i]) for i in order) for row in relation.fetchall())
    assert got == expected


def test_names_and_contract(spark):
    assert set(ORACLE) <= set(QUERIES)
    assert contract.entry(spark).count() > 0
