"""Every registered query equals its SQL on the smallest test tables."""

import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import check  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
# those of the training-data subpackage have tests of their own
OWN = sorted(name for name in queries() if name != "pipeline" and not re.match(r"op\d+_", name))


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for table in check.TABLES.split():
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", OWN)
def test_query(spark, tables, name):
    line = check.compare(spark, tables, name, SF_DIR)
    assert line.startswith(("ok", "rows")), line


def test_entry(spark):
    assert entry(spark).count() > 0


def test_all_queries_have_sql():
    assert set(OWN) <= set(oracle_sql())
