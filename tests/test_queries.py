"""Every query against its SQL in DuckDB, on the smallest tables."""

import glob
import os

import pytest

import __spark_entry__ as entry_point

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 9)
    return value


@pytest.mark.parametrize("name", sorted(entry_point.oracle_sql()))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    cursor = duck.execute(entry_point.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted((tuple(plain(r[i]) for i in order) for r in cursor.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
