"""Every registered query against its SQL, and the shape of the plans."""

import pytest
from conftest import SF
from parity import compare, duck_connection

import __spark_entry__ as driver
from ledgerloom.operators import events as ev
from ledgerloom.plans import CATALOG, views


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF)


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_agrees_with_sql(spark, duck, name):
    assert compare(spark, duck, name, SF) == "" or (
        CATALOG[name].sql is None and CATALOG[name].run(spark, SF).columns
    )


def test_driver_contract(spark):
    assert set(driver.oracle_sql()) < set(driver.queries()) >= set(CATALOG)
    flagship = driver.entry(spark)
    assert flagship.count() == 150 and "rejection_reason" in flagship.columns


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


# Queries that read back what a job of theirs wrote show only the read in their plan.
@pytest.mark.parametrize("name", list(CATALOG))
def test_plans_stay_on_the_jvm_without_products(spark, name):
    plan = _plan(CATALOG[name].run(spark, SF))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_only_needed_columns_are_read(spark):
    plan = _plan(CATALOG["monthly_revenue"].run(spark, SF))
    assert "ReadSchema: struct<o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_rankings_are_top_n_and_aggregate_before_the_join(spark):
    for name in ("top10_members_by_spending", "top3_items_by_frequency"):
        plan = _plan(CATALOG[name].run(spark, SF))
        assert "TakeOrderedAndProject" in plan
        assert plan.index("Join") < plan.index("HashAggregate")


def test_daily_metrics_read_the_events_once(spark):
    jobs = _plan(ev.daily_metrics(views.image_events(spark, SF)))
    assert "FileScan" not in jobs
