"""Every catalogue query against its SQL, and the shape of the plans."""

from pathlib import Path

import pytest
from check_catalog import differences, open_duckdb

import __spark_entry__
from kinbridge import catalog

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="needs the given tables")

QUERIES, SQL = catalog.QUERIES, catalog.oracle_sql()
NO_SQL = {"kpi_daily_active_estimate"}
GLOBAL_AGGREGATES = {
    "column_profile", "contract_violations", "stream_late_rows", "warehouse_row_counts",
}

@pytest.fixture(scope="module")
def con():
    return open_duckdb(DATA)


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == NO_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) & set(SQL)))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, DATA)
    assert differences(df, con, SQL[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert bad not in plan
    # Only global aggregates, one row per task, may meet in one partition.
    assert "SinglePartition" not in plan or name in GLOBAL_AGGREGATES


def test_estimate_is_close(spark):
    exact = {r.event_date: r for r in QUERIES["kpi_daily_active"](spark, DATA).collect()}
    for row in QUERIES["kpi_daily_active_estimate"](spark, DATA).collect():
        want = exact[row.event_date].daily_active_customers
        assert abs(row.daily_active_customers - want) <= max(1, want * 0.05)


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["app_tenant_pairs"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in plan


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == [
        "canonical_customer_id", "event_count", "net_result_usdt",
    ]
