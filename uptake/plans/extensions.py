"""Measures that the metric's specification describes beyond the core marts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake import vocabulary as v
from uptake.functions import labels, scoring
from uptake.functions.calendar import day
from uptake.functions.numeric import UNITS, exact_sum, headline_score, ratio, rnd
from uptake.operators.components import sku_history
from uptake.operators.contracts import contract_features
from uptake.operators.staging import SKU, SKU_MONTH, sku_month
from uptake.params import HARSH_OVERAGE, SMOOTH_ACTIVATION, Override
from uptake.plans.marts import Raw, customer_sku_month, customer_sku_month_overridden

# Our order of the states for counting moves, worst first.
STATE_RANK = {
    v.CHURN: 1,
    v.LAPSED: 2,
    v.SHELFWARE: 3,
    v.STALL: 4,
    v.CRITICAL: 5,
    v.AT_RISK: 6,
    v.GRACE: 7,
    v.DEVELOPING: 8,
    v.REALIZED: 9,
}


def value_realized_share(sku_month_mart: DataFrame) -> DataFrame:
    """Accounts whose weighted score reaches the top band, as a share, per month."""
    accounts = sku_month_mart.groupBy("month", "cust_id").agg(
        headline_score(F.col("vrs"), F.col("arr")).alias("score")
    )
    top = F.count_if(scoring.band(F.col("score")) == v.REALIZED)
    return accounts.groupBy("month").agg(
        F.count("*").alias("accounts"),
        top.alias("value_realized_accounts"),
        rnd(ratio(top, F.count("*")) * F.lit(100.0), 2).alias("value_realized_pct"),
    )


def _rank(state: Column) -> Column:
    pairs = [F.lit(x) for item in STATE_RANK.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), state)


def _moves(sku_month_mart: DataFrame) -> DataFrame:
    before = F.lag("state").over(sku_history())
    return (
        sku_month_mart.select("month", F.col("state").alias("to_state"), before.alias("from_state"))
        .where(F.col("from_state").isNotNull())
        .withColumn("step", F.signum(_rank(F.col("to_state")) - _rank(F.col("from_state"))).cast("int"))
    )


def state_transitions(sku_month_mart: DataFrame) -> DataFrame:
    """Moves between states from one row of a SKU to its next, per month."""
    way = F.when(F.col("step") > 0, "up").when(F.col("step") < 0, "down").otherwise("same")
    return (
        _moves(sku_month_mart)
        .groupBy("month", "from_state", "to_state", way.alias("direction"))
        .agg(F.count("*").alias("moves"))
    )


def net_transitions(sku_month_mart: DataFrame) -> DataFrame:
    """Moves up minus moves down, per month."""
    return (
        _moves(sku_month_mart)
        .groupBy("month")
        .agg(
            F.count_if(F.col("step") > 0).alias("up"),
            F.count_if(F.col("step") < 0).alias("down"),
            F.sum("step").alias("net"),
        )
    )


def first_adopted(raw: Raw) -> DataFrame:
    """First month with events and peak intensity, per SKU and feature."""
    monthly = (
        raw["feature_adoption"]
        .groupBy(*SKU, "feature_id", "month")
        .agg(F.sum("usage_events").alias("events"))
        .groupBy(*SKU, "feature_id")
        .agg(
            F.min(F.when(F.col("events") > 0, F.col("month"))).alias("first_adopted_month"),
            F.count_if(F.col("events") > 0).alias("active_months"),
            F.max("events").alias("peak_events"),
        )
    )
    deep = raw["features"].select("feature_id", "deep_threshold_events")
    intensity = rnd(ratio(F.col("peak_events"), F.col("deep_threshold_events")), 4)
    return (
        monthly.join(deep, "feature_id")
        .withColumn("peak_intensity", intensity)
        .select(*SKU, "feature_id", "first_adopted_month", "active_months", "peak_events", "peak_intensity")
    )


def feature_shelfware(raw: Raw, since: str | None = None) -> DataFrame:
    """Features a SKU is entitled to and never used, or not in any month from ``since`` on."""
    entitled = contract_features(raw["entitlements"].select(*SKU).distinct(), raw["features"])
    events = raw["feature_adoption"].where(F.col("usage_events") > 0)
    if since is not None:
        events = events.where(F.col("month") >= day(since))
    used = events.select(*SKU, "feature_id").distinct()
    return entitled.join(used, [*SKU, "feature_id"], "left_anti").select(*SKU, "feature_id")


def component_categories(sku_month_mart: DataFrame) -> DataFrame:
    """The category of each component, per SKU-month."""
    return sku_month_mart.select(
        *SKU_MONTH,
        labels.utilization_category(F.col("lur")).alias("utilization_category"),
        labels.feature_category(F.col("feature_adoption")).alias("feature_category"),
        labels.sustained_category(F.col("sustained_usage")).alias("sustained_category"),
        labels.speed_category(F.col("ttv_days"), F.col("ttv_score")).alias("speed_category"),
    )


def params_override(raw: Raw, overrides: list[Override]) -> DataFrame:
    return customer_sku_month_overridden(raw, overrides)


def smooth_curve(raw: Raw) -> DataFrame:
    """The mart under the activation ramp without a step."""
    return customer_sku_month(raw, SMOOTH_ACTIVATION)


def overage_cap_60(raw: Raw) -> DataFrame:
    """The mart under the harsher overage ceiling."""
    return customer_sku_month(raw, HARSH_OVERAGE)


def ttv_first_signal(raw: Raw) -> DataFrame:
    """The mart when a first feature event counts as first value, too."""
    return customer_sku_month(raw, from_features=True)


def naive_utilization(consumption: DataFrame) -> DataFrame:
    """Cumulative consumed / licensed per SKU: the single ratio the score replaces."""
    so_far = sku_history().rowsBetween(Window.unboundedPreceding, 0)
    consumed = exact_sum(F.col("consumed_units"), UNITS).over(so_far)
    licensed = F.sum("licensed_amount").over(so_far)
    return sku_month(consumption).select(*SKU_MONTH, rnd(ratio(consumed, licensed), 6).alias("naive_utilization"))


def peer_percentile(sku_month_mart: DataFrame) -> DataFrame:
    """Percent rank of each score among the product's scores of the month.

    A score has at most 1001 values, so ranks come from a histogram per product
    and month; no task ever sorts the rows of a popular product.
    """
    peers = ["month", "product_id"]
    histogram = sku_month_mart.where(F.col("vrs").isNotNull()).groupBy(*peers, "vrs").agg(F.count("*").alias("n"))
    below = Window.partitionBy(*peers).orderBy("vrs").rowsBetween(Window.unboundedPreceding, -1)
    ranked = histogram.select(
        *peers,
        "vrs",
        F.coalesce(F.sum("n").over(below), F.lit(0)).alias("lower"),
        F.sum("n").over(Window.partitionBy(*peers)).alias("peers"),
    )
    share = F.when(F.col("peers") == 1, F.lit(0.0)).otherwise(ratio(F.col("lower"), F.col("peers") - 1))
    return (
        sku_month_mart.select(*SKU_MONTH, "vrs")
        .join(ranked, [*peers, "vrs"], "left")
        .select(*SKU_MONTH, "vrs", rnd(share, 6).alias("peer_percentile"))
    )
