"""Every registered query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of
from lodestrata.workload.lake import TABLES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
# Fits of several seconds each; the models have tests of their own.
SLOW = {"model_compare", "forest_importance", "ridge_importance", "ridge_metrics", "residual_summary", "kmeans_select",
        "cluster_profile", "mart_priority"}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - SLOW))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, DATA)
    ours = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert ours
        return
    result = con.execute(sql)
    names, theirs = [d[0] for d in result.description], result.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, ours) == rows_of(names, theirs)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
