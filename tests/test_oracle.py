"""Every registered query against its SQL on DuckDB: names, types and values."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from arrivals_engine import catalogue, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = ("region", "nation", "customer", "orders", "lineitem")

DUCK_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')"
        )
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(v)) for v in row))


def test_every_query_has_sql():
    assert set(catalogue.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(catalogue.queries()))
def test_matches_sql(spark, duck, name):
    frame = catalogue.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    relation = duck.sql(oracle.oracle_sql()[name])
    assert sorted(relation.columns) == columns

    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: DUCK_TYPES[t] for c, t in frame.dtypes} == duck_types

    quoted = ", ".join(f'"{c}"' for c in columns)
    expected = in_order(relation.project(quoted).fetchall())
    actual = in_order(tuple(row) for row in frame.select(*columns).collect())
    assert len(actual) > 0
    assert actual == expected


def test_entry_has_rows(spark):
    assert spark_entry.entry(spark).count() == 10
