"""Plays, anomaly labels and other texts shown to readers."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from uptake import vocabulary as v
from uptake.functions.numeric import rnd

_OWNER = {play: owner for play, owner, *_ in v.PLAYS}


# ---- facts of an account: aggregates over its rows ------------------------


def any_collapse() -> Column:
    return F.bool_or(F.col("state").isin(v.CHURN, v.LAPSED))


def any_shelfware() -> Column:
    return F.bool_or(F.col("state") == v.SHELFWARE)


def any_expansion() -> Column:
    return F.bool_or(F.coalesce(F.col("flag_expansion"), F.lit(False)))


def any_fragile() -> Column:
    return F.bool_or(F.coalesce(F.col("flag_single_feature_dependency"), F.lit(False)))


def largest_overage() -> Column:
    return F.max(F.when(F.col("flag_expansion"), F.col("lur")))


# ---- ladders over those facts --------------------------------------------


def play(collapse: Column, shelfware: Column, expansion: Column) -> Column:
    """Win back before Activate before Upsell; NULL when none applies."""
    return F.when(collapse, "Win back").when(shelfware, "Activate").when(expansion, "Upsell")


def play_owner(name: Column) -> Column:
    return lookup(name, _OWNER, fallback=F.lit(None).cast("string"))


def play_advice(name: Column, overage: Column) -> Column:
    """'Play · Owner', with the largest overage spelled out for an upsell."""
    base = F.concat(name, F.lit(" · "), play_owner(name))
    upsell = F.concat(base, F.lit(" (overage "), percent_text(overage), F.lit(")"))
    return F.when(name == "Upsell", upsell).otherwise(F.coalesce(base, F.lit(v.NO_PLAY)))


def anomaly(collapse: Column, shelfware: Column, expansion: Column, single: Column) -> Column:
    """Shelfware before a drop before overage: not the order of the plays."""
    first, second, third, fourth = v.ANOMALIES
    return (
        F.when(shelfware, first)
        .when(collapse, second)
        .when(expansion, third)
        .when(single, fourth)
        .otherwise(v.NO_ANOMALY)
    )


def anomaly_counts_text(shelf: Column, drop: Column, overage: Column) -> Column:
    """'2 shelfware · 1 overage'; pieces with a zero count are left out."""
    pieces = [
        F.when(count > 0, F.concat(count.cast("string"), F.lit(" " + noun)))
        for count, noun in ((shelf, "shelfware"), (drop, "spike & drop"), (overage, "overage"))
    ]
    text = F.concat_ws(" · ", *pieces)
    return F.when(text == "", v.NO_ANOMALY).otherwise(text)


# ---- small texts ---------------------------------------------------------


def percent_text(share: Column) -> Column:
    return F.concat(rnd(share * F.lit(100.0), 0).cast("long").cast("string"), F.lit("%"))


def lookup(code: Column, table: dict[str, str], fallback: Column | None = None) -> Column:
    """Dictionary lookup inside the plan; unknown codes keep ``fallback`` (the code itself)."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*entries), code), code if fallback is None else fallback)


def platform_label(code: Column) -> Column:
    return lookup(code, v.PLATFORM_LABELS)


def model_name(product_name: Column) -> Column:
    """Product name without its trailing ' SKU-n'."""
    return F.regexp_replace(product_name, r"\s*SKU-\d+$", "")


def direction(change: Column, dead_zone: float = 0.0) -> Column:
    """up / down / flat; changes smaller than ``dead_zone`` count as flat."""
    still = F.abs(change) < F.lit(dead_zone) if dead_zone else change == F.lit(0.0)
    return F.when(still, "flat").when(change > F.lit(0.0), "up").when(change < F.lit(0.0), "down")


# ---- category labels of the four components ------------------------------


def utilization_category(lur: Column) -> Column:
    return (
        F.when(lur < F.lit(0.10), "Shelfware")
        .when(lur < F.lit(0.60), "Underutilized")
        .when(lur < F.lit(1.00), "Healthy")
        .when(lur <= F.lit(1.20), "Fully utilized")
        .when(lur > F.lit(1.20), "Overage")
    )


def feature_category(score: Column) -> Column:
    return (
        F.when(score < F.lit(0.25), "Narrow")
        .when(score < F.lit(0.50), "Partial")
        .when(score <= F.lit(0.75), "Broad")
        .when(score > F.lit(0.75), "Broad + deep")
    )


def sustained_category(score: Column) -> Column:
    return (
        F.when(score >= F.lit(1.0), "Durable")
        .when(score >= F.lit(0.5), "Recent")
        .when(score > F.lit(0.0), "Churn signal")
        .when(score == F.lit(0.0), "Dormant")
    )


def speed_category(days: Column, score: Column) -> Column:
    """A NULL score is the grace period."""
    return (
        F.when(score.isNull(), "Grace period")
        .when(days <= 30, "Fast")
        .when(days <= 90, "Slow")
        .otherwise("Onboarding stall")
    )
