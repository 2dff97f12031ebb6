"""Every query of the package that has SQL against it, and the plans of those that must stay native."""

import parity
import pytest

from macrospark.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert parity.difference(QUERIES[name](spark, SF), parity.connect(SF), ORACLE[name]) is None


@pytest.mark.parametrize("name", ["op7_url_filter", "op9_sharding", "op10_licenses"])
def test_native_plans_run_no_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
