"""Every registered query against its SQL on the smallest tables."""

import math
from pathlib import Path

import pytest

import __spark_entry__ as entry

SF = Path("/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="supplied tables not present")

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for file in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return ("float", "nan")
    if isinstance(value, (int, float)) and not isinstance(value, bool):
        return ("number", value)
    return (type(value).__name__, str(value))


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(cell(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sql, name):
    df = QUERIES[name](spark, str(SF))
    rows = df.collect()
    if name not in SQL:
        pytest.skip("no SQL can express it; tested beside its operator")
    found = sql.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, rows) == table(columns, found.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_its_query():
    assert set(SQL) <= set(QUERIES)
