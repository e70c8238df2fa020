"""Every registered batch query against its DuckDB oracle on sf0.001 (the
driver checks sf0.01; tools/oracle_check.py runs that locally)."""

import duckdb
import pytest

import __spark_entry__ as entry
from adpulse.plans import BATCH_QUERIES, STREAM_QUERIES
from helpers import SF_SMALL
from tools.oracle_check import TABLES, compare


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert {**BATCH_QUERIES, **STREAM_QUERIES}.keys() <= entry.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_batch_query_matches_oracle(spark, con, name):
    r = compare(name, spark, con, SF_SMALL, entry.queries(), entry.oracle_sql())
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


@pytest.mark.parametrize("name", ["stream_job_metrics", "stream_distinct", "stream_progress", "stream_group_count_filled"])
def test_stream_query_matches_oracle(spark, con, name):
    r = compare(name, spark, con, SF_SMALL, entry.queries(), entry.oracle_sql())
    assert r["columns_match"] and r["values_match"] and r["spark_rows"] == r["oracle_rows"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "publisher", "geo", "date", "imps",
                          "uniques", "avg_bids"]
