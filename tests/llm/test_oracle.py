"""The queries SQL can express against DuckDB, by value, over a whole test table."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb
import pytest

from daymark.llm import oracle, queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", sorted(oracle.statements()))
def test_equals_sql(spark, tables, name):
    found = queries.registered()[name](spark, FOLDER)
    wanted = tables.execute(oracle.statements()[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    rows = [tuple(row) for row in found.select(*columns).collect()]
    assert Counter(rows) == Counter(wanted.fetchall())


def test_every_dealt_operator_has_one_query():
    names = list(queries.registered())
    assert [name.split("_")[0] for name in names] == [f"op{n}" for n in range(1, 14)]
    assert set(oracle.statements()) <= set(names)
