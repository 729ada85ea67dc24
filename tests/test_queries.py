"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry

TABLES = Path(registry.SMALLEST)
pytestmark = pytest.mark.skipif(not TABLES.exists(), reason="no test tables")


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


# the optional training-data queries have tests of their own
OPTIONAL = {"pipeline", *registry.llm.queries()} if registry.llm else set()
NAMES = [name for name in registry.queries() if name not in OPTIONAL]


def test_every_query_has_sql():
    assert set(NAMES) == registry.oracle_sql().keys() - OPTIONAL


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, name):
    got = registry.queries()[name](spark, str(TABLES))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{TABLES}/events.parquet'")
    result = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(names)
    assert sorted_rows(got.columns, got.collect()) == sorted_rows(names, result.fetchall())
