"""Every text query that SQL can express, against DuckDB on the same tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))
from compare import same  # noqa: E402

from keyflow.llm import queries as Q  # noqa: E402

SF = "/root/testdata/sf0.001"


def duck(sql, sf=SF, **frames):
    con = duckdb.connect()
    for name in ("documents", "pages", "benchmark", "labels"):
        if name in frames:
            con.register(name, frames[name])
        else:
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con.execute(sql).fetchdf()


def longs(df):
    return df.astype({c: "Int64" for c in ("first_word", "last_word") if c in df.columns})


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_query_equals_sql(spark, name):
    got = Q.queries()[name](spark, SF).toPandas()
    assert len(got) and same(longs(got), longs(duck(Q.oracle_sql()[name])))


def test_queries_are_the_dealt_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.queries()) == list(range(1, 14))
