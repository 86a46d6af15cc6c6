"""The shape of the plans: what is shuffled, read and never done."""

import re
from collections import Counter

import pytest

from uptake.catalog import QUERIES, workspace

FOLDER = "/root/testdata/sf0.001"

# Windows without a partition: over one row per month, or per shuffle partition.
ONE_TASK_WINDOWS = {"kpi_movement", "surrogate_key", "quota_cohort"}


@pytest.fixture(scope="module")
def space(spark):
    return workspace(spark, FOLDER)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", QUERIES)
def test_no_cross_joins_no_python_no_single_task_windows(space, name):
    plan = plan_of(QUERIES[name](space))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert not re.search(r"Python|Pandas|ArrowEval", plan)
    lonely = re.search(r"Window \[.*\n\s*[:+\- ]*(\*\(\d+\) )?Sort \[.*\n\s*[:+\- ]*Exchange SinglePartition", plan)
    assert bool(lonely) == (name in ONE_TASK_WINDOWS)


def test_sku_mart_without_broadcasts(spark, space):
    """Sort-merge joins throughout: the plan of data too large to broadcast."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, -1)
    try:
        plan = plan_of(QUERIES["mart_customer_sku_month"](space))
    finally:
        spark.conf.set(setting, before)
    assert "Broadcast" not in plan
    # contracts to products, product list, contracts to SKUs, usage, events,
    # events to features, feature list, grades, history
    assert plan.count("Exchange hashpartitioning") == 9
    assert plan.count("Window [") == 1
    assert plan.count("partial_sum") >= 3


def test_months_are_pruned_and_columns_are_few(space):
    plan = plan_of(QUERIES["portfolio_kpis"](space))
    assert re.search(r"PartitionFilters: \[isnotnull\(month#\d+\), \(month#\d+ = 2026-06-01\)\]", plan)
    assert "ReadSchema: struct<cust_id:string,arr:double,vrs:double,flag_expansion:boolean>" in plan


def test_movers_shuffle_once(space):
    plan = plan_of(QUERIES["top_movers"](space))
    main = plan.split("Subquery")[0]
    assert main.count("Exchange hashpartitioning(cust_id") == 1
    assert "TakeOrderedAndProject" in plan


def test_movers_read_two_months(space):
    """The previous month comes from a sub-query, and still prunes partitions."""
    df = QUERIES["top_movers"](space)
    df.collect()
    assert [partitions for _, partitions in scans(df._jdf.queryExecution().executedPlan())] == [2]


@pytest.mark.parametrize("name", ["months", "latest_month", "top_movers", "band_share_change_qoq", "kpi_movement"])
def test_months_come_from_the_calendar(space, name):
    """No scan reads the mart only to learn its months, sub-queries included."""
    assert "ReadSchema: struct<>" not in plan_of(QUERIES[name](space))


def scans(node):
    """Columns and partitions read of every file scan, inside query stages too."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return scans(node.executedPlan())
    if name.endswith("QueryStageExec"):
        return scans(node.plan())
    found = []
    if name.startswith("FileSourceScan"):
        found.append((node.requiredSchema().simpleString(), node.metrics().apply("numPartitions").value()))
    children = node.children()
    for i in range(children.size()):
        found += scans(children.apply(i))
    return found


def test_anomaly_counts_do_not_expand_rows(space):
    assert "Expand" not in plan_of(QUERIES["product_model_table"](space))
    assert "Expand" not in plan_of(QUERIES["customer_kpis"](space))


def test_report_reads_each_table_a_few_times(space):
    """One fold of the mart to accounts and one to its grain; of usage to contracts, months and accounts."""
    reads = Counter(tables_read(QUERIES["dq_report"](space)._jdf.queryExecution().executedPlan()))
    assert reads["mart_customer_sku_month"] == 2
    assert reads["consumption"] == 3
    assert reads["feature_adoption"] == reads["features"] == 1
    assert reads.total() <= 16


def tables_read(node) -> list[str]:
    """The stored table behind every file scan of a plan that hasn't run yet."""
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        return tables_read(node.executedPlan())
    if name.startswith("FileSourceScan"):
        return [node.relation().location().rootPaths().apply(0).getName().rpartition("-")[0]]
    children = node.children()
    return [t for i in range(children.size()) for t in tables_read(children.apply(i))]


def test_customers_of_a_product_are_counted_after_one_fold(space):
    plan = plan_of(QUERIES["mart_product_month"](space))
    assert re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)[0].count("#") == 2  # product and month
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("HashAggregate") == 2


def test_spine_needs_no_shuffle(space):
    plan = plan_of(QUERIES["month_spine"](space))
    assert "Exchange" not in plan
    assert "Join" not in plan
