"""Every registered query against its SQL on the smallest tables."""

import collections
import os

import duckdb
import pytest

import __spark_entry__ as entry_points

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def oracle(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(sf_small, t)}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, oracle, sf_small, name):
    df = entry_points.queries()[name](spark, sf_small)
    columns = sorted(df.columns)
    got = collections.Counter(tuple(map(repr, r)) for r in df.select(*columns).collect())
    picked = ", ".join(f'"{c}"' for c in columns)
    rel = oracle.sql(entry_points.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    want = oracle.sql(f"SELECT {picked} FROM ({entry_points.oracle_sql()[name]})").fetchall()
    assert got == collections.Counter(tuple(map(repr, r)) for r in want)


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - set(entry_points.oracle_sql())))
def test_query_runs(spark, sf_small, name):
    assert entry_points.queries()[name](spark, sf_small).count() > 0


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["PARTITION_ID", "MAE", "RMSE", "ROWS"]
