"""Every query with SQL is held against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    text = lambda x: "" if x is None or x is pd.NaT or (isinstance(x, float) and pd.isna(x)) else f"{x:.8g}" if isinstance(x, float) else str(x)
    sort = lambda d: d[sorted(d.columns)].map(text).sort_values(sorted(d.columns)).reset_index(drop=True)
    pd.testing.assert_frame_equal(sort(a), sort(b))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def names():
    from tidemark.plans import job_queries, oracles, report_queries, store_queries

    return sorted(oracles.ORACLES | store_queries.ORACLES | job_queries.ORACLES | report_queries.ORACLES)


@pytest.mark.parametrize("name", names())
def test_query(spark, duck, name):
    from tidemark.plans import job_queries, oracles, queries, report_queries, store_queries

    plans = queries.QUERIES | store_queries.QUERIES | job_queries.QUERIES | report_queries.QUERIES
    sql = oracles.ORACLES | store_queries.ORACLES | job_queries.ORACLES | report_queries.ORACLES
    same(plans[name](spark, SF).toPandas(), duck.execute(sql[name]).df())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
