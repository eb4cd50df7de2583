"""Every registered query against its SQL on the smallest tables, and rules for all plans."""

import math
import re

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as register
from loanlens.registry.core import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES.split():
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SMALL}/{name}.parquet')")
    return connection


def shown(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(shown(r[i]) for i in order) for r in records)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(register.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, result.fetchall())
    text = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|ArrowEvalPython|BatchEvalPython|MapInPandas", text)


def test_entry(spark):
    df = register.entry(spark)
    assert df.columns[0] == "snapshot_date" and df.count() > 0
