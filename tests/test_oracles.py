"""Every registered query against its SQL on DuckDB."""

import math
import os

import duckdb
import pytest

from ledgerspark.testbed.all import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(records, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [tuple(canonical(record[i]) for i in order) for record in records]
    return sorted(rows, key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    actual = rows_of(result.collect(), result.columns)
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    expected = rows_of(cursor.fetchall(), columns)
    assert sorted(result.columns) == sorted(columns)
    assert len(actual) == len(expected)
    assert actual == expected
