"""Every registered query against its SQL, as sorted rows with columns by name."""

import datetime
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from response_ledger.oracles import ORACLES
from response_ledger.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, datetime.date) and not isinstance(value, datetime.datetime):
        return value.isoformat()
    if value.__class__.__name__ in ("Timestamp", "datetime"):
        return value.isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


_SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def test_every_query_of_the_library_has_its_sql():
    assert set(QUERIES) == set(ORACLES) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query_matches_its_sql(spark, connection, name):
    frame = queries()[name](spark, SF_DIR)
    expected = connection.execute(oracle_sql()[name])
    names = [one[0] for one in expected.description]
    kinds = {one[0]: str(one[1]) for one in expected.description}
    rows = expected.fetchall()
    assert sorted(frame.columns) == sorted(names)
    for column, kind in frame.dtypes:
        assert _SAME[kind] == kinds[column], (column, kind, kinds[column])
    assert rows
    assert _rows(frame.columns, [tuple(one) for one in frame.collect()]) == _rows(names, rows)


def test_entry(spark):
    frame = entry(spark)
    assert frame.columns == ["id"]
    assert frame.count() > 0
