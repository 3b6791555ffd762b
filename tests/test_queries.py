"""Every registered query against its SQL in DuckDB, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from linktide.plans.oracle import ORACLE_SQL
from linktide.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(row[i] for i in order) for row in rows)


def test_all_queries_have_an_oracle():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= queries().keys()
    assert ORACLE_SQL.items() <= oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    actual = _sorted(result.columns, result.collect())
    cursor = duck.execute(ORACLE_SQL[name])
    assert actual == _sorted([d[0] for d in cursor.description], cursor.fetchall())
    assert actual[1]


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["position", "id", "rank"]
    assert result.count() == 349  # customers in credit, suppliers and parts
