"""Plan shape of the registered batch queries: no cartesian products or
nested-loop joins, and scans read only the columns they need."""

import pytest

from adpulse.plans import BATCH_QUERIES
from helpers import SF_SMALL


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_no_cartesian_or_nested_loop(spark, name):
    df = BATCH_QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_events_scan_is_pruned(spark):
    df = BATCH_QUERIES["fine_window_agg"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    read_schema = plan.split("ReadSchema: ")[1].split("\n")[0]
    assert "event_type" not in read_schema and "props" in read_schema


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_each_table_scanned_once(spark, name):
    """Raw tables are read once per query; intermediates read by several
    branches are checkpointed (their scan happened inside the checkpoint)."""
    df = BATCH_QUERIES[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for table in ("events.parquet", "documents.parquet"):
        assert plan.count(table) <= 1, (name, table)
