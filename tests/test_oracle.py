"""Every registered query equals its DuckDB oracle (sf0.001, whole tables).

The second run forces tiny scan buckets so the two-level (hot key) paths
of running aggregates, count windows and sessions are exercised too.
"""

import os

import duckdb
import pytest

import __spark_entry__ as E
from keyflow import catalog
from compare import same
from conftest import SF_SMALL

TABLES = ["nation", "customer", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(catalog.queries()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert len(got) == len(want)
    assert same(got, want)


@pytest.mark.parametrize("name", ["rolling_sum", "rolling_min_by", "rolling_max_by",
                                  "count_trigger", "count_evictor", "count10_list",
                                  "session_keyed", "session_all", "late_flag",
                                  "distinct_users_running", "exclude_asof",
                                  "avg_passengers_per_pickup_running"])
def test_query_matches_oracle_with_tiny_buckets(spark, con, name):
    spark.conf.set("spark.keyflow.scan.rowsPerBucket", "7")
    try:
        got = E.queries()[name](spark, SF_SMALL).toPandas()
    finally:
        spark.conf.unset("spark.keyflow.scan.rowsPerBucket")
    want = con.execute(E.oracle_sql()[name]).df()
    assert same(got, want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["website", "window_start", "window_end", "clicks"]
    assert os.path.isdir(E.SMOKE_DIR)
