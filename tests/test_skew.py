"""One key that holds a third of all rows: same result, bounded groups."""

import pytest
from pyspark.sql import functions as F

from uptake import schemas
from uptake.functions.calendar import day, months_between_inclusive
from uptake.operators import components, contracts, staging
from uptake.plans import extensions, marts

ROWS = 60_000


@pytest.fixture(scope="module")
def usage(spark):
    """Consumption where one SKU has a third of the rows, as many small contracts."""
    hot = F.col("id") % 3 == 0
    return spark.range(ROWS).select(
        F.format_string("U%d", "id").alias("consumption_id"),
        F.when(hot, F.format_string("H%d", F.col("id") % 5000)).otherwise(F.format_string("E%d", F.col("id") % 900)).alias("entitlement_id"),
        F.when(hot, "C0").otherwise(F.format_string("C%d", F.col("id") % 900)).alias("cust_id"),
        F.when(hot, "P0").otherwise("P1").alias("product_id"),
        F.add_months(day("2025-07-01"), (F.floor(F.col("id") / 7) % 12).cast("int")).alias("month"),
        (F.col("id") % 50).cast("double").alias("consumed_units"),
        F.lit(25).cast("long").alias("licensed_amount"),
    )


def test_hot_sku_reaches_the_window_as_months(spark, usage):
    stg = staging.sku_month(usage)
    sizes = stg.groupBy("cust_id", "product_id").count()
    assert sizes.agg(F.max("count")).first()[0] <= 12
    direct = usage.where("cust_id = 'C0' AND product_id = 'P0'").agg(F.sum("consumed_units")).first()[0]
    folded = stg.where("cust_id = 'C0' AND product_id = 'P0'").agg(F.sum("consumed_units")).first()[0]
    assert folded == direct
    plan = stg._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_sum") > plan.index("Exchange hashpartitioning")  # below it in the tree


def test_hot_contracts_reach_the_window_as_dates(spark):
    n = 30_000
    rows = spark.range(n).select(
        F.format_string("E%d", "id").alias("entitlement_id"),
        F.when(F.col("id") % 3 == 0, "C0").otherwise(F.format_string("C%d", "id")).alias("cust_id"),
        F.lit("P1").alias("product_id"),
        F.add_months(day("2025-07-01"), (F.col("id") % 4).cast("int")).alias("start_date"),
    ).withColumn("end_date", F.add_months("start_date", 2))
    got = {r.cust_id: r.pairs for r in contracts.overlap_pairs(rows).where("cust_id = 'C0'").collect()}
    # 2500 contracts start in each of 4 months and last 2: neighbours overlap
    k = n // 3 // 4
    assert got["C0"] == 4 * k * (k - 1) // 2 + 3 * k * k


def test_popular_product_is_ranked_through_its_histogram(spark):
    values = {"product_id": F.lit("P1"), "month": day("2025-07-01")}
    mart = spark.range(20_000).select(
        F.format_string("C%d", "id").alias("cust_id"),
        *[x.alias(n) for n, x in values.items()],
        (F.col("id") % 1000 / 10).alias("vrs"),
    )
    ranked = extensions.peer_percentile(mart)
    got = {r.vrs: r.peer_percentile for r in ranked.where("vrs in (0.0, 50.0)").distinct().collect()}
    assert got == {0.0: 0.0, 50.0: round(10_000 / 19_999, 6)}
    assert ranked.count() == 20_000


def test_result_does_not_depend_on_partitioning(spark, usage):
    empty = spark.createDataFrame([], "cust_id string, product_id string, month date, feature_adoption double")
    one, many = (
        components.sku_components(staging.sku_month(usage.repartition(n)), empty).orderBy("cust_id", "product_id", "month").collect()
        for n in (1, 13)
    )
    assert one == many


def test_skewed_joins_are_split(spark, usage):
    """With broadcasts off and small limits, AQE splits the hot side of the name join."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10000",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, x in settings.items():
        spark.conf.set(k, x)
    try:
        blank = {f.name: F.lit(None).cast(f.dataType) for f in schemas.SKU_MONTH}
        known = {c: F.col(c) for c in ("cust_id", "product_id", "month")}
        columns = blank | known | {"arr": F.xxhash64("consumption_id").cast("double")}
        hot = usage.repartition(16).select(*[c.alias(n) for n, c in columns.items()])
        people = spark.createDataFrame([(f"C{i}", f"Name {i}", "R", "S", "x") for i in range(900)], schemas.CUSTOMERS)
        things = spark.createDataFrame([("P0", "Zero", "sase", "x"), ("P1", "One", "sase", "x")], schemas.PRODUCTS)
        full = marts.sku_month_full(hot, people, things)
        assert full.count() == ROWS
        full.collect()
        plan = full._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, x in before.items():
            spark.conf.unset(k) if x is None else spark.conf.set(k, x)


def test_month_list_helper(spark):
    row = spark.range(1).select(months_between_inclusive(day("2025-11-01"), day("2026-02-01")).alias("m")).first()
    assert [str(x) for x in row.m] == ["2025-11-01", "2025-12-01", "2026-01-01", "2026-02-01"]
