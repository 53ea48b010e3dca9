"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import TABLES, canonical
from gaugeworks.plans.catalog import QUERIES

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    frame = queries()[name](spark, SF_DIR)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(oracle_sql()[name])
    want = canonical([c[0] for c in cursor.description], cursor.fetchall())
    assert got == want and got[1]
