"""Every registered query against its SQL oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, text = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok, text


def test_entry(spark):
    assert entry.entry(spark).count() > 0
