"""Months appended from carried state against full builds."""

import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CALENDAR, Book
from uptake import jobs, schemas
from uptake.plans import marts, monthly
from uptake.sources import tables


@pytest.fixture(scope="module")
def raw(spark):
    """SKUs with gaps, silence, unknown licences, late first value, two contracts and none."""
    rng = random.Random(11)
    book = Book(spark)
    for p in range(3):
        book.product(f"P{p}")
        if p < 2:
            book.feature(f"F{p}", f"P{p}")
    for c in range(12):
        book.customer(f"C{c}")
        for p in range(3):
            key = book.contract(f"C{c}", f"P{p}", start=rng.choice(["2025-07-01", "2025-10-15"]))
            months = [m for m in CALENDAR if rng.random() < 0.8] or CALENDAR[:1]
            quiet = rng.choice([0, 0, 4, 9, 11, 12])
            units = [0 if CALENDAR.index(m) < quiet else rng.choice([0, 3, 30, 80, 130]) for m in months]
            book.use(key, f"C{c}", f"P{p}", months, units, rng.choice([100, 100, 0]))
            if p < 2:
                book.events(key, f"C{c}", f"P{p}", f"F{p}", months, [rng.randrange(100) for _ in months])
    extra = book.contract("C1", "P1", expansion=True)
    book.use(extra, "C1", "P1", CALENDAR, [5] * 12)
    made = book.raw()
    return {name: df.persist() for name, df in made.items()}


def until(raw, month):
    return {n: df.where(F.col("month") <= F.lit(month)) if "month" in df.columns else df for n, df in raw.items()}


def rows(df):
    return sorted(map(str, df.select(*schemas.SKU_MONTH.names).collect()))


def test_states_advance_month_by_month(spark, raw):
    state = spark.createDataFrame([], monthly.STATE)
    for k, month in enumerate(CALENDAR):
        before = spark.createDataFrame(state.collect(), monthly.STATE)
        state = monthly.advance(before, raw, str(month))
        if k in (0, 3, 8, 11):
            assert sorted(map(str, state.collect())) == sorted(map(str, monthly.state_through(raw, str(month)).collect()))
            full = marts.customer_sku_month(until(raw, month))
            assert rows(monthly.month_rows(before, raw, str(month))) == rows(full.where(F.col("month") == F.lit(month)))


def test_a_month_reads_its_own_facts_only(spark, raw, tmp_path, capsys):
    for name in ("consumption", "feature_adoption"):
        raw[name].write.parquet(f"{tmp_path}/{name}")
    stored = {**raw, **{n: spark.read.schema(schemas.RAW[n]).parquet(f"{tmp_path}/{n}") for n in ("consumption", "feature_adoption")}}
    state = spark.createDataFrame([], monthly.STATE)
    monthly.month_rows(state, stored, str(CALENDAR[11])).explain()
    plan = capsys.readouterr().out
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("EqualTo(month," in line for line in scans)
    assert "Window" not in plan


def test_appended_months_equal_a_full_build(spark, raw, tmp_path):
    target = str(tmp_path)
    first = until(raw, CALENDAR[8])
    tables.write_by_month(tables.conform(marts.customer_sku_month(first), schemas.SKU_MONTH), f"{target}/mart_customer_sku_month")
    for month in CALENDAR[9:]:
        jobs.append(spark, until(raw, month), target, str(month))
    assert rows(jobs.mart(spark, target, "mart_customer_sku_month")) == rows(marts.customer_sku_month(raw))
    # A late correction of the month before the last one: both months again, from the states before them.
    fixed = {**raw, "consumption": raw["consumption"].withColumn(
        "consumed_units", F.when((F.col("month") == F.lit(CALENDAR[10])) & (F.col("cust_id") == "C3"), 95.0).otherwise(F.col("consumed_units")))}
    for month in CALENDAR[10:]:
        jobs.append(spark, until(fixed, month), target, str(month))
    after = jobs.mart(spark, target, "mart_customer_sku_month")
    want = marts.customer_sku_month(fixed)
    late = F.col("month") >= F.lit(CALENDAR[10])
    assert rows(after.where(late)) == rows(want.where(late))
