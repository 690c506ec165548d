"""Plan shapes: what must not be in them, and what must."""

import os

import pytest

from cairn.plans import catalog
from cairn.plans.profile import plan_facts, profile

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def test_profile_reports_failures(spark):
    def bad(spark, sf_dir):
        raise ValueError("no")

    out = {r["name"]: r for r in profile(spark, SF, {"good": catalog.queries()["op_D26_distinct"], "bad": bad}).collect()}
    assert out["good"]["rows"] > 0 and out["good"]["error"] is None and out["bad"]["error"] == "no"


def test_scan_is_pruned_and_filtered(spark):
    plan = catalog.queries()["op_A9_scan_prune"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_shipdate)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name, most", [("op_D4_ordered_first", 1), ("op_E1_keep_first", 1), ("op_E10_lag_flow", 1), ("op_D1_flag_pivot", 1), ("op_K24_prevalence", 3)])
def test_shuffles_are_few(spark, name, most):
    facts = plan_facts(catalog.queries()[name](spark, SF))
    assert facts["exchanges"] <= most and not facts["nested_loops"] and not facts["cartesian"] and not facts["python"]


def test_keep_first_uses_the_group_limit(spark):
    plan = catalog.queries()["op_E1_keep_first"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
