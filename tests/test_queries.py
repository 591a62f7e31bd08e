"""Every registered query against its SQL, on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def cell(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "NULL"
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def test_every_query_has_sql_and_the_other_way_round():
    assert set(QUERIES) == set(ORACLE) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() == 25


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    result = duck.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())
