"""Every registered query against its SQL, run by DuckDB on the same tables."""

import math
import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="tables are not here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([row[i] for i in order] for row in rows), key=_sortable_text)


def _sortable_text(row):
    return [repr(value) for value in row]


def _family(value):
    if value is None or isinstance(value, bool):
        return type(value)
    return float if isinstance(value, float) else int if isinstance(value, int) else str


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    rows = [tuple(r) for r in result.collect()]
    if name not in ORACLES:
        assert rows
        return
    cursor = duck.execute(ORACLES[name])
    expected_columns = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    assert sorted(result.columns) == sorted(expected_columns)
    assert len(rows) == len(expected)
    for mine, theirs in zip(_rows(result.columns, rows), _rows(expected_columns, expected)):
        for a, b in zip(mine, theirs):
            same_nan = isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b)
            assert same_nan or (a == b and _family(a) == _family(b)), (mine, theirs)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    scored = entry_point.entry(spark)
    assert scored.count() > 0
    assert scored.columns[-1] == "prediction"
