"""Every registered query against its SQL on the given tables."""

import math
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry_module
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, Decimal):
        return round(float(value), 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def views():
    connection = duckdb.connect()
    for name in sorted(os.listdir(SF_DIR)):
        table = name.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, views, name):
    frame = QUERIES[name](spark, SF_DIR)
    rows = rows_of(frame.columns, frame.collect())
    assert rows
    if name not in ORACLES:
        return
    result = views.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = rows_of(columns, result.fetchall())
    assert len(rows) == len(expected)
    assert rows == expected


def test_registries_agree():
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry_module.entry(spark).count() == 6
