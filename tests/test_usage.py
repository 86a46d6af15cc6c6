"""Source tables derived from a small star schema of the test's own rows."""

import datetime as dt
import re

import pytest

from uptake import schemas
from uptake.catalog import QUERIES, RULED_MART, USAGE, Workspace
from uptake.sources.star import Star

STAR = {
    "region": ("r_regionkey int, r_name string", [(0, "EUROPE")]),
    "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "N", 0)]),
    "supplier": ("s_suppkey long, s_name string, s_nationkey int, s_acctbal double", [(8, "A", 0, 5000.0), (5, "B", 0, 10.0)]),
    "part": ("p_partkey long, p_type string, p_size int", [(1, "SMALL", 1), (2, "SMALL", 14), (3, "LARGE", None)]),
    "lineitem": (
        "l_suppkey long, l_partkey long, l_quantity double, l_shipdate timestamp",
        [
            (8, 1, 2.5, dt.datetime(1994, 9, 3)),
            (8, 1, None, dt.datetime(1999, 9, 30)),
            (8, 2, 4.0, dt.datetime(1994, 6, 1)),
            (8, 2, 7.0, None),
            (8, 3, 3.0, dt.datetime(1994, 6, 1)),
            (5, 1, 9.0, dt.datetime(1994, 2, 1)),
            (5, 1, 9.0, dt.datetime(1994, 2, 2)),
            (5, 1, 2.0, dt.datetime(1994, 2, 2)),
            (5, 2, 1.0, None),
            (None, 1, 1.0, dt.datetime(1994, 2, 2)),
            (8, 77, 1.0, dt.datetime(1994, 2, 2)),
        ],
    ),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("star")
    for name, (schema, rows) in STAR.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def table(spark, folder, name):
    return Star(spark, folder).table(name)


def test_usage_meets_its_months(spark, folder):
    rows = table(spark, folder, "consumption").where("consumed_units > 0").collect()
    assert sorted((r.cust_id, r.entitlement_id.endswith("x"), str(r.month), r.consumed_units) for r in rows) == [
        ("C5", False, "2026-02-01", 10.0),
        ("C5", True, "2026-02-01", 10.0),
        ("C8", False, "2025-09-01", 2.5),
        ("C8", False, "2026-06-01", 3.0),
        ("C8", False, "2026-06-01", 4.0),
    ]


def test_lines_become_events_of_their_size_and_month(spark, folder):
    rows = table(spark, folder, "feature_adoption").collect()
    found = sorted((r.cust_id, r.entitlement_id.endswith("x"), r.feature_id[-1], str(r.month), r.usage_events) for r in rows if r.usage_events)
    assert found == [
        ("C5", False, "0", "2026-02-01", 2),
        ("C5", True, "0", "2026-02-01", 1),
        ("C8", False, "0", "2025-09-01", 2),
        ("C8", False, "1", "2026-06-01", 1),
    ]
    # A part without a size has rows, but no use of any feature; a size that only undated lines show has rows, too.
    assert [r.usage_events for r in rows if r.feature_id is None] == [0]
    assert sum(r.cust_id == "C5" and r.feature_id.endswith("-1") for r in rows) == 11


def test_derived_tables_do_not_shuffle_months(spark, folder):
    """A SKU's months stay in one row until the tables are written."""
    usage = spark.createDataFrame([], USAGE)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, -1)
    try:
        plans = [Star(spark, folder).table(n, usage)._jdf.queryExecution().executedPlan().toString() for n in ("consumption", "feature_adoption")]
    finally:
        spark.conf.set(setting, before)
    for plan in plans:
        dealt = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)
        assert dealt and all(keys.count("#") == 2 for keys in dealt)  # supplier and part type


def test_the_report_on_the_ruled_mart_builds_no_other(spark, folder):
    with_rules = Workspace(spark, folder)
    values = {r.test: r.val for r in QUERIES["dq_report_override"](with_rules).collect()}
    assert values["mart_sku_month_schema"] == len(schemas.SKU_MONTH_ASSERTED)
    assert with_rules.store.has(RULED_MART) and not with_rules.store.has("mart_customer_sku_month")
    with_rules.close()
