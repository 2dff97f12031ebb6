"""Every registered query against its SQL, and the plans of the main ones."""

import pytest

import __spark_entry__ as entry_point
import parity
from macrospark.catalog import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return parity.connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, con, name):
    assert parity.difference(QUERIES[name](spark, SF), con, ORACLE[name]) is None


def test_parity_notices_a_changed_value(spark, con):
    df = QUERIES["monthly_mart"](spark, SF)
    assert parity.difference(df.withColumn("year", df.year + 1), con, ORACLE["monthly_mart"]) is not None
    assert parity.difference(df.limit(5), con, ORACLE["monthly_mart"]) is not None


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_plans_stay_on_the_jvm_without_cross_joins(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan


def test_filters_and_columns_reach_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(QUERIES["period_window"](spark, SF))
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "In(o_orderpriority" in plan_of(QUERIES["series_subset"](spark, SF))
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_k_recent"](spark, SF))


def test_entity_features_shuffle_no_grid(spark):
    """Densifying and both windows share the one shuffle by entity."""
    plan = plan_of(QUERIES["entity_features"](spark, SF))
    after = plan[: plan.index("SortAggregate") if "SortAggregate" in plan else plan.index("HashAggregate")]
    assert after.count("Exchange hashpartitioning(c_nationkey") == 1
