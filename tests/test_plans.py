"""Scale rules checked on every registered query's physical plan."""

import os
import re

import pytest

import __spark_entry__ as entry
from tallyloom import plans

SF = "/root/testdata/sf0.001"
plans.load_all()
LIBRARY = plans.QUERIES  # the corpus queries have tests of their own
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", sorted(LIBRARY))
def test_plan_has_no_cross_join_or_python(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"BroadcastNestedLoopJoin|CartesianProduct", plan), "no cross joins"
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroupsInPandas", plan), \
        "no Python in tasks"


def _initial(df) -> str:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[-1]


def test_code_lookup_needs_no_exchange(spark):
    """Orders meet a literal code table without being shuffled."""
    assert "hashpartitioning(status_code" not in _initial(entry.queries()["multi_code_lookup"](spark, SF))
    assert "hashpartitioning(priority_code" not in _initial(entry.queries()["multi_code_lookup"](spark, SF))


def test_no_forced_broadcast(spark):
    """With the size threshold off nothing is broadcast: no join is forced by a hint."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in sorted(LIBRARY):
            assert "BroadcastExchange" not in _initial(entry.queries()[name](spark, SF)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
