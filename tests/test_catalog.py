"""Every registered query against its SQL, run by DuckDB on the same tables."""

import math
from pathlib import Path

import pytest

from maskflow.catalog import QUERIES, SQL

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9))
    return repr(value)


def rows(table):
    names = sorted(table.column_names)
    columns = [table.column(name).to_pylist() for name in names]
    types = [str(table.schema.field(name).type) for name in names]
    return names, types, sorted(tuple(map(plain, row)) for row in zip(*columns))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = rows(QUERIES[name](spark, str(FOLDER)).toArrow())
    found = duck.execute(SQL[name])
    want = rows(found.to_arrow_table() if hasattr(found, "to_arrow_table") else found.fetch_arrow_table())
    assert got == want


def test_sql_has_queries():
    assert set(SQL) == set(QUERIES)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() == 1500
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
