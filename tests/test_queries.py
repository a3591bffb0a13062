"""Registered queries against their SQL on the smallest driver tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
# The long plans are compared by check.py; here one of each kind will do.
PLANS = {"features_fast", "features_plain", "features_lite", "features_ensemble_target"}
COMPARED = [n for n in ORACLE if not n.startswith("features_") or n in PLANS]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not present")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_sql_has_its_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", COMPARED)
def test_query(spark, tables, name):
    result = compare(QUERIES[name](spark, SF_DIR), tables.sql(ORACLE[name]))
    assert result.startswith("ok") and "TYPES" not in result, result
