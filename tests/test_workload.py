"""Every registered query against its SQL on the smallest data set."""

import math
import os

import pytest

import __spark_entry__ as driver

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for name in os.listdir(DATA):
        table = name.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{name}'")
    return con


def canonical(rows, order):
    def cell(value):
        return "nan" if isinstance(value, float) and math.isnan(value) else repr(value)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    frame = driver.queries()[name](spark, DATA)
    expected = duck.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(frame.columns)
    order = sorted(columns)
    assert canonical(frame.collect(), [frame.columns.index(c) for c in order]) == canonical(
        expected.fetchall(), [columns.index(c) for c in order]
    )


def test_every_query_has_sql():
    assert set(driver.queries()) - set(driver.oracle_sql()) == set(driver.CORPUS) - set(driver.CORPUS_SQL)


def test_entry_is_the_nested_table(spark):
    rows = driver.entry(spark)
    assert rows.columns == [
        "name", "day", "run_ts", "part", "metadata", "viewerspermin", "chatspermin"
    ]
    assert rows.count() > 0
