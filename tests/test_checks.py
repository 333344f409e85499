"""Every query against its independent SQL on the driver's tables."""

from __future__ import annotations

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_point
from tidemark.plans import catalog
from tidemark.plans.checks import CHECK_SQL as CHECKS

FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("events", "customer", "nation"):
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(CHECKS) <= set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_check(spark, duck, name):
    frame = QUERIES[name](spark, FOLDER)
    found = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    relation = duck.sql(CHECKS[name])
    expected = _sorted_rows(relation.columns, relation.fetchall())
    assert sorted(frame.columns) == sorted(relation.columns)
    assert len(found) == len(expected)
    assert found == expected


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
