"""A month's rows of the headline mart from carried state instead of all history.

The window frames of a row look back three rows, and ask whether the SKU was ever active and when it
first was. One row a SKU holds all of that, so a new month is one join of that month's facts with the state: neither fact is
read beyond the month, whatever the length of the history. ``advance`` turns the state before a month into
the state after it. After a late correction of a month, the state before it still holds, and the months from there on are appended again.

One thing looks forward: the days to first value are shown on all rows of a SKU, so a SKU whose first value falls into the
new month changes its earlier rows, too. ``first_valued`` names these SKUs; only their rows have to be restated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake import schemas
from uptake.functions import scoring
from uptake.functions.calendar import day
from uptake.operators import staging
from uptake.operators.staging import SKU
from uptake.params import DEFAULTS, ScoreParams
from uptake.plans import marts

#: Newest first; ``lur1`` and ``active1`` belong to the last row of the SKU.
STATE = schemas.schema(
    "cust_id:string product_id:string lur1:double lur2:double lur3:double active1:int active2:int "
    "ever_active:int first_value_month:date"
)


def _month_of(consumption: DataFrame, month: str, p: ScoreParams) -> DataFrame:
    rows = staging.sku_month(consumption.where(F.col("month") == day(month)))
    return rows.withColumn("active", scoring.in_use(F.col("lur"), p))


def state_through(raw: marts.Raw, month: str, p: ScoreParams = DEFAULTS) -> DataFrame:
    """The state after ``month`` from all history up to it; used once, and to check ``advance``."""
    rows = staging.sku_month(raw["consumption"].where(F.col("month") <= day(month)))
    rows = rows.withColumn("active", scoring.in_use(F.col("lur"), p))
    place = F.row_number().over(Window.partitionBy(*SKU).orderBy(F.desc("month")))

    def nth(name: str, k: int) -> Column:
        return F.max(F.when(F.col("place") == k, F.col(name))).alias(f"{name}{k}")

    return (
        rows.withColumn("place", place)
        .groupBy(*SKU)
        .agg(
            *[nth("lur", k) for k in (1, 2, 3)],
            *[nth("active", k) for k in (1, 2)],
            F.max("active").alias("ever_active"),
            F.min(F.when(F.col("active") == 1, F.col("month"))).alias("first_value_month"),
        )
    )


def advance(state: DataFrame, raw: marts.Raw, month: str, p: ScoreParams = DEFAULTS) -> DataFrame:
    """The state after ``month`` from the one before it; a SKU without a row in the month keeps its own."""
    now = _month_of(raw["consumption"], month, p).select(*SKU, F.col("month").alias("now"), "lur", "active")
    joined = state.join(now, SKU, "full")

    def moved(new: str, old: str) -> Column:
        return F.when(F.col("now").isNotNull(), F.col(new)).otherwise(F.col(old)).alias(old)

    return joined.select(
        *SKU,
        moved("lur", "lur1"),
        moved("lur1", "lur2"),
        moved("lur2", "lur3"),
        moved("active", "active1"),
        moved("active1", "active2"),
        F.greatest("ever_active", "active").alias("ever_active"),
        F.coalesce("first_value_month", F.when(F.col("active") == 1, F.col("now"))).alias("first_value_month"),
    )


def month_rows(state: DataFrame, raw: marts.Raw, month: str, p: ScoreParams = DEFAULTS) -> DataFrame:
    """The headline mart's rows of ``month``, from the state before it, that month's facts and the contracts."""
    events = raw["feature_adoption"].where(F.col("month") == day(month))
    breadth = staging.feature_adoption_avg(staging.feature_month(events, raw["features"], p))
    base = _month_of(raw["consumption"], month, p).join(breadth, staging.SKU_MONTH, "left").join(state, SKU, "left")
    known = [F.col(f"lur{k}") for k in (3, 2, 1)]
    seen = sum((k.isNotNull().cast("int") for k in known[1:]), known[0].isNotNull().cast("int"))
    earlier = sum((F.coalesce(k, F.lit(0.0)) for k in known[1:]), F.coalesce(known[0], F.lit(0.0)))
    rows = base.select(
        *staging.SKU_MONTH,
        "lur",
        F.coalesce("feature_adoption", F.lit(0.0)).alias("feature_adoption"),
        scoring.utilization_health(F.col("lur"), p).alias("util_health"),
        scoring.sustained_usage(F.col("active"), F.col("active1"), F.col("active2"), p).alias("sustained_usage"),
        F.when(seen > 0, earlier / seen).alias("prior_lur"),
        F.coalesce("ever_active", F.lit(0)).alias("ever_active_before"),
        F.coalesce("first_value_month", F.when(F.col("active") == 1, F.col("month"))).alias("first_value_month"),
    )
    scored = marts.scored(rows.join(marts.sku_side(raw), SKU), p, F.col("first_value_month"))
    return marts.present(scored, p)


def first_valued(state: DataFrame, raw: marts.Raw, month: str, p: ScoreParams = DEFAULTS) -> DataFrame:
    """The SKUs known before ``month`` whose first value falls into it: their earlier rows show other days to first value now."""
    waiting = state.where(F.col("first_value_month").isNull()).select(*SKU)
    return _month_of(raw["consumption"], month, p).where("active = 1").select(*SKU).join(waiting, SKU, "left_semi")


def restated(raw: marts.Raw, skus: DataFrame, month: str, p: ScoreParams = DEFAULTS) -> DataFrame:
    """All rows of ``skus`` before ``month``, built anew from their own facts up to and with it."""
    own = dict(raw)
    for name in ("consumption", "feature_adoption"):
        own[name] = raw[name].where(F.col("month") <= day(month)).join(skus, SKU, "left_semi")
    return marts.customer_sku_month(own, p).where(F.col("month") < day(month))
