"""Plan guards: properties that must hold at any scale, checked on the
physical plans of the registered read-only queries."""

import re

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
# Keys that write targets while being built are checked by the oracle sweep only.
WRITING = ("a0", "a1", "b0", "b1", "b2", "j15", "j16", "j17")
MAINTAINED = ("_incremental", "_moving_window", "_from_footers")
KEYS = sorted(k for k in E.queries() if not k.startswith(WRITING) and not k.endswith(MAINTAINED))


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", KEYS)
def test_no_pairwise_joins_or_global_windows(spark, key):
    plan = _plan(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    # A window without PARTITION BY runs every row in one task.
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line):
            assert "], [" in line and not re.search(r"\], \[\], \[", line), line


def test_recent_filter_reaches_the_scan(spark):
    df = E.queries()["j03_recent_products"](spark, SF)
    scans = [ln for ln in df._jdf.queryExecution().executedPlan().toString().splitlines()
             if "FileScan parquet" in ln and "orders" in ln]
    assert any("GreaterThanOrEqual(o_orderdate" in ln for ln in scans), scans


def test_projection_is_pruned_at_the_scan(spark):
    df = E.queries()["j02_spend_per_customer"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    orders_scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln and "orders.parquet" in ln]
    assert orders_scan
    for ln in orders_scan:
        assert "o_orderpriority" not in ln and "o_orderstatus" not in ln


def test_rls_facts_are_not_shuffled_by_country(spark):
    plan = _plan(E.queries()["j08_email_activity_analyst"](spark, SF))
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning(cntry_cd" not in plan
