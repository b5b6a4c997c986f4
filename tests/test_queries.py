"""Registered queries against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def value(x):
    return round(float(x), 6) if isinstance(x, float) or type(x).__name__ == "Decimal" else x


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = db.sql(entry.oracle_sql()[name])
    got = entry.queries()[name](spark, SF)
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    rows = lambda names, data: sorted((tuple(value(r[names.index(c)]) for c in columns) for r in data), key=repr)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_entry_and_names():
    assert set(entry.oracle_sql()) <= set(entry.queries())
