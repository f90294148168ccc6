"""Every registered query: against its SQL twin, or for rows; and the shape of its plan."""

import pytest

from demandloom.catalog import ORACLES, QUERIES
from tests.compare import differences


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, folder, name):
    assert differences(spark, duck, QUERIES[name], ORACLES[name], folder) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, folder, name):
    assert QUERIES[name](spark, folder).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan_has_no_pair_join(spark, folder, name):
    plan = QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_entry_runs(spark):
    import __spark_entry__ as contract

    rows = contract.entry(spark).collect()
    assert len(rows) == 20 and rows[0]["quality"] in ("PASS", "WARNING", "FAIL")
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_features_share_one_window(spark, folder):
    plan = QUERIES["rolling_features"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("+- Window [") == 1


def test_scan_reads_only_needed_columns(spark, folder):
    plan = QUERIES["panel_read_filtered"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "o_custkey" not in plan
