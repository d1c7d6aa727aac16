"""Plan shape checks over every registered query: no cartesian products; nested-loop joins
only where infix LIKE patterns are joined on distinct keys."""

from growthframe.plans import registry
from tests.conftest import SF_SMALL

registry.load_all()
ALLOWED_NESTED_LOOP = {"k8_map_patterns_all", "k8_map_patterns_best"}


def test_no_cartesian_and_bounded_nested_loops(spark):
    bad = {}
    for name, build in sorted(registry.QUERIES.items()):
        plan = build(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        if "CartesianProduct" in plan:
            bad[name] = "CartesianProduct"
        elif "BroadcastNestedLoopJoin" in plan and name not in ALLOWED_NESTED_LOOP:
            bad[name] = "BroadcastNestedLoopJoin"
    assert not bad, bad


def test_scans_are_pruned_and_filters_pushed(spark):
    plan = registry.QUERIES["j11_semi_join"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    lineitem = [s for s in scans if "l_orderkey" in s]
    # only the two lineitem columns the semi join needs are read, and the filter reaches the scan
    assert lineitem and "l_quantity" not in lineitem[0] and "l_shipdate" not in lineitem[0]
    assert "(l_returnflag" in lineitem[0] and "= R)" in lineitem[0]
