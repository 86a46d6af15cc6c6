"""The steps that move most rows deal them once."""

import datetime as dt
import re

import pytest

from uptake import schemas
from uptake.catalog import USAGE
from uptake.operators import staging
from uptake.sources.star import Star
from uptake.sources.tables import conform


@pytest.fixture
def no_broadcasts(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, -1)
    yield
    spark.conf.set(setting, before)


def dealt(df) -> list[list[str]]:
    """The columns of each hash exchange, the one nearest to the result first."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [re.findall(r"(\w+)#", keys) for keys in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]


def test_line_items_are_dealt_for_their_parts_and_their_cells_only(spark, tmp_path, no_broadcasts):
    day = dt.datetime(1994, 9, 3)
    lines = [(8, 1, 1.005, day), (8, 1, None, day), (8, 2, 4.0, None), (None, 1, 1.0, day), (8, 9, 1.0, day), (8, 1, 4.0, day)]
    spark.createDataFrame(lines, "l_suppkey long, l_partkey long, l_quantity double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    parts = [(1, "SMALL", 1), (2, None, None)]
    spark.createDataFrame(parts, "p_partkey long, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    usage = Star(spark, str(tmp_path)).monthly_usage()
    assert dealt(usage) == [["suppkey", "p_type", "size_class"], ["l_partkey"], ["p_partkey"]]
    assert conform(usage, USAGE).schema == USAGE
    found = {(r.suppkey, r.p_type, r.size_class): (r.lines_09, r.quantity_09, r.lines_06) for r in usage.collect()}
    assert found == {(8, "SMALL", 0): (3, 501, None), (8, None, None): (None, None, None), (None, "SMALL", 0): (1, 100, None)}


def test_events_and_the_mean_of_their_grades_share_an_exchange(spark, tmp_path):
    month = dt.date(2025, 7, 1)
    rows = [(f"A{i}", "C1", f"E{i % 2}", "P1", f"F{i // 2}", month, n) for i, n in enumerate((2, 2, 1, None, 9, 0))]
    events = spark.createDataFrame(rows, schemas.FEATURE_ADOPTION)
    spark.createDataFrame([(f"F{i}", f"N{i}", "", "P1", 3, 6) for i in range(3)], schemas.FEATURES).write.parquet(f"{tmp_path}/features")
    features = spark.read.parquet(f"{tmp_path}/features")
    graded = staging.feature_month(events, features)
    mean = staging.feature_adoption_avg(graded)
    plan = dealt(mean)
    assert plan[0] == ["cust_id", "product_id", "month"] and len(plan) == 1, plan
    assert {r.feature_id: r.usage_events for r in graded.collect()} == {"F0": 4, "F1": 1, "F2": 9}
    scores = [r.feature_score for r in graded.collect()]
    assert mean.first().feature_adoption == pytest.approx(sum(scores) / 3, abs=1e-3)
