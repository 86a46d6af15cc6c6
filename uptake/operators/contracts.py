"""Contract terms and the calendar of a contract."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.functions.calendar import (
    day,
    first_month_from,
    last_month_before,
    month_index,
    months_between_inclusive,
)
from uptake.functions.numeric import exact_sum, rnd
from uptake.operators.staging import SKU

TERM_MONTHS = 12


def ent_start(entitlements: DataFrame, *more: Column) -> DataFrame:
    """First start date and revenue per SKU, over all its contracts."""
    return entitlements.groupBy(*SKU).agg(
        F.min("start_date").alias("start_date"),
        exact_sum(F.col("arr")).cast("double").alias("arr"),
        *more,
    )


def contract_union(base: DataFrame, expansions: DataFrame) -> DataFrame:
    """Base contracts and expansions in one table, told apart by ``is_expansion``."""
    return base.withColumn("is_expansion", F.lit(False)).unionByName(
        expansions.withColumn("is_expansion", F.lit(True))
    )


def contract_terms(orders: DataFrame, months: int = TERM_MONTHS) -> DataFrame:
    """Adds ``arr`` and ``end_date`` to units, price and start."""
    return orders.withColumn("arr", rnd(F.col("units_purchased") * F.col("unit_price"), 2)).withColumn(
        "end_date", F.add_months("start_date", months)
    )


def month_spine(contracts: DataFrame, lo: str | Column, hi: str | Column) -> DataFrame:
    """One row per contract and active month within [lo, hi], with its month index.

    A contract is active while ``start_date <= month < end_date``. The months
    are exploded from each row, so there is neither a join nor a shuffle.
    """
    first = F.greatest(first_month_from(F.col("start_date")), first_month_from(day(lo)))
    last = F.least(last_month_before(F.col("end_date")), F.trunc(day(hi), "MM"))
    return (
        contracts.where(first <= last)
        .withColumn("month", F.explode(months_between_inclusive(first, last)))
        .withColumn("month_idx", month_index(F.col("start_date"), F.col("month")))
    )


def contract_features(entitlements: DataFrame, features: DataFrame) -> DataFrame:
    """Every feature a contract entitles to: contract x features of its product."""
    return entitlements.join(features.select("product_id", "feature_id"), "product_id")


def active_length(spine: DataFrame) -> DataFrame:
    """Adds the number of active months of the contract and feature.

    A group is one contract and feature, so it holds at most the calendar's months.
    """
    return spine.withColumn(
        "active_len", F.count("*").over(Window.partitionBy("entitlement_id", "feature_id"))
    )


def licensed_by_month(entitlements: DataFrame, lo: str, hi: str) -> DataFrame:
    """Licence of the concurrently active contracts per SKU and month."""
    return month_spine(entitlements, lo, hi).groupBy(*SKU, "month").agg(F.sum("licensed_amount").alias("lic"))


def overlap_pairs(entitlements: DataFrame) -> DataFrame:
    """Number of contract pairs of one SKU whose windows overlap.

    Two contracts overlap when each starts before the other ends. Contracts are first
    counted per start and end date, and no pair of them is formed. Of the n(n-1)/2 pairs of a
    SKU those that do not overlap are the ones where one contract ends on or before
    the day the other starts; with starts and ends counted per day, a running
    count of ends gives their number. A window group therefore has at most two
    rows per distinct contract date, however many contracts share it.

    A contract that ends on or before its start overlaps those that start before its end and
    end after its start, and no other of its kind. Such terms are joined with the SKU's other
    terms: both sides have one row per pair of dates. Contracts without a date take no part.
    """
    terms = (
        entitlements.where(F.col("start_date").isNotNull() & F.col("end_date").isNotNull())
        .groupBy(*SKU, "start_date", "end_date")
        .agg(F.count("*").alias("n"))
    )
    windows = terms.where(F.col("start_date") < F.col("end_date"))
    empty = terms.where(F.col("start_date") >= F.col("end_date"))
    inside = empty.select(*SKU, F.col("start_date").alias("from"), F.col("end_date").alias("until"), F.col("n").alias("m"))
    around = (
        windows.join(inside, SKU)
        .where((F.col("start_date") < F.col("until")) & (F.col("from") < F.col("end_date")))
        .groupBy(*SKU)
        .agg(F.sum(F.col("n") * F.col("m")).alias("pairs"))
    )
    parts = [_window_pairs(windows), around, empty.select(*SKU, F.lit(0).cast("long").alias("pairs"))]
    return reduce(DataFrame.unionByName, parts).groupBy(*SKU).agg(F.sum("pairs").alias("pairs"))


def _window_pairs(windows: DataFrame) -> DataFrame:
    """Overlapping pairs of contracts that end after their start, counted in ``n`` per term."""
    events = windows.select(
        *SKU,
        F.inline(
            F.array(
                F.struct(F.col("start_date").alias("on"), F.col("n").alias("opened"), F.lit(0).cast("long").alias("closed")),
                F.struct(F.col("end_date").alias("on"), F.lit(0).cast("long").alias("opened"), F.col("n").alias("closed")),
            )
        ),
    )
    daily = events.groupBy(*SKU, "on").agg(
        F.sum("opened").cast("decimal(19,0)").alias("opened"), F.sum("closed").cast("decimal(19,0)").alias("closed")
    )
    closed_so_far = F.sum("closed").over(
        Window.partitionBy(*SKU).orderBy("on").rowsBetween(Window.unboundedPreceding, 0)
    )
    opened = F.sum("opened")
    apart = F.sum(F.col("opened") * F.col("closed_so_far").cast("decimal(19,0)"))
    return (
        daily.withColumn("closed_so_far", closed_so_far)
        .groupBy(*SKU)
        .agg((opened * (opened - 1) / 2 - apart).cast("long").alias("pairs"))
    )
