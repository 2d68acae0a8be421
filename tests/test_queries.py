"""Every registered query against its SQL counterpart, on the smallest tables."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from querybook.oracles import ORACLES
from querybook.queries import QUERIES


@pytest.fixture(scope="module")
def db(data):
    connection = duckdb.connect()
    for file in Path(data).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, db, name):
    df = driver.queries()[name](spark, data)
    result = db.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = bag(columns, result.fetchall())
    assert want, "a query without rows shows nothing"
    assert bag(df.columns, df.collect()) == want


def test_entry(spark):
    assert driver.entry(spark).columns == ["task_id", "url", "depth", "status_code"]
