"""Every registered query against its SQL counterpart in DuckDB, on whole tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tallyvault.queries import registry

DATA = Path("/root/testdata/sf0.001")
QUERIES, SQL = registry(), contract.oracle_sql()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() <= SQL.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert len(QUERIES) > 90


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows(spark, tables, name):
    found = QUERIES[name](spark, str(DATA))
    expected = tables.execute(SQL[name])
    names = [column[0] for column in expected.description]
    assert sorted(names) == sorted(found.columns)

    def plain(value):
        return round(value, 6) if isinstance(value, float) else value

    def rows(records):
        return sorted((tuple(plain(v) for v in record) for record in records), key=repr)

    assert rows(found.select(*names).collect()) == rows(expected.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() == 10
