"""The corpus queries that SQL can express against their SQL, on the smallest tables."""

import glob
import os

import duckdb
import pytest

from curate.llm.oracle import ORACLE
from curate.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def cell(value):
    return f"{value:.9g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        duck.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = duck.execute(ORACLE[name])
    columns = sorted(d[0] for d in result.description)
    df = QUERIES[name](spark, SF_DIR)
    assert sorted(df.columns) == columns
    got = sorted([cell(v) for v in r] for r in df.select(columns).collect())
    order = [[d[0] for d in result.description].index(c) for c in columns]
    assert got == sorted([cell(r[i]) for i in order] for r in result.fetchall())
    assert got
