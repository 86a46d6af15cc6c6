"""The scoring rules as Column expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from uptake import vocabulary as v
from uptake.params import DEFAULTS, ScoreParams, as_column


def utilization_health(lur: Column, p: ScoreParams = DEFAULTS) -> Column:
    """Piecewise curve over utilization. A NULL ratio lands on the overage score."""
    ramp = as_column(p.ramp_base) + (lur - as_column(p.use_floor)) * as_column(p.ramp_slope)
    healthy = as_column(p.healthy_base) + (lur - as_column(p.healthy_from)) * as_column(p.healthy_slope)
    return (
        F.when(lur < as_column(p.use_floor), F.lit(0.0))
        .when(lur < as_column(p.healthy_from), ramp)
        .when(lur < as_column(p.full_from), healthy)
        .when(lur <= as_column(p.overage_above), as_column(p.full_score))
        .otherwise(as_column(p.overage_score))
    )


def in_use(lur: Column, p: ScoreParams = DEFAULTS) -> Column:
    """1 / 0 for meaningful use in the month, NULL for an unknown ratio."""
    return (lur >= as_column(p.use_floor)).cast("int")


def feature_points(events: Column, floor: Column, deep: Column, p: ScoreParams = DEFAULTS) -> Column:
    """Graded adoption of one feature, 0 for no events."""
    return (
        F.when(events == 0, F.lit(0.0))
        .when(events < floor, as_column(p.feature_idle))
        .when(events < deep, as_column(p.feature_active))
        .otherwise(as_column(p.feature_deep))
    )


def mean_of_points(points: Column) -> Column:
    """Mean of graded points, summed as whole thousandths so that order is irrelevant."""
    thousandths = F.round(points * F.lit(1000.0)).cast("long")
    return F.sum(thousandths) / (F.lit(1000.0) * F.count(points))


def adoption_level(score: Column, p: ScoreParams = DEFAULTS) -> Column:
    none, idle, active, deep = v.LEVELS
    return (
        F.when(score == F.lit(0.0), none)
        .when(score == as_column(p.feature_idle), idle)
        .when(score == as_column(p.feature_active), active)
        .otherwise(deep)
    )


def sustained_usage(now: Column, back1: Column, back2: Column, p: ScoreParams = DEFAULTS) -> Column:
    """Recency-weighted presence, renormalised over the rows that exist."""
    w0, w1, w2 = as_column(p.recency_0), as_column(p.recency_1), as_column(p.recency_2)
    nothing = F.lit(0.0)
    earned = w0 * now + w1 * F.coalesce(back1, F.lit(0)) + w2 * F.coalesce(back2, F.lit(0))
    possible = w0 + F.when(back1.isNull(), nothing).otherwise(w1) + F.when(back2.isNull(), nothing).otherwise(w2)
    return earned / possible


def speed_score(days: Column, p: ScoreParams = DEFAULTS) -> Column:
    """Days from contract start to first value, scored 1 -> 0; never counts as 0."""
    fast, slow = as_column(p.fast_days), as_column(p.slow_days)
    return (
        F.when(days.isNull(), F.lit(0.0))
        .when(days <= fast, F.lit(1.0))
        .when(days <= slow, F.lit(1.0) - (days - fast) / (slow - fast))
        .otherwise(F.lit(0.0))
    )


def in_grace(start_date: Column, month: Column, health: Column) -> Column:
    """First calendar month of the contract, and nothing used yet."""
    return (F.trunc(start_date, "MM") == month) & (health == F.lit(0.0))


def composite(
    health: Column,
    features: Column,
    sustained: Column,
    speed: Column,
    has_features: Column,
    grace: Column,
    p: ScoreParams = DEFAULTS,
) -> Column:
    """0-100 score; terms that do not apply leave both sides of the fraction."""
    applies = (
        (F.lit(True), as_column(p.weight_utilization), health),
        (has_features, as_column(p.weight_features), features),
        (F.lit(True), as_column(p.weight_sustained), sustained),
        (~F.coalesce(grace, F.lit(False)), as_column(p.weight_speed), speed),
    )
    nothing = F.lit(0.0)
    points = reduce(Column.__add__, [F.when(on, w * x).otherwise(nothing) for on, w, x in applies])
    weights = reduce(Column.__add__, [F.when(on, w).otherwise(nothing) for on, w, _ in applies])
    return F.lit(100.0) * points / weights


def fragile(has_features: Column, features: Column, lur: Column, p: ScoreParams = DEFAULTS) -> Column:
    """Heavy use that rests on almost no features."""
    return has_features & (features < as_column(p.fragile_features)) & (lur >= as_column(p.fragile_utilization))


def expanding(lur: Column, p: ScoreParams = DEFAULTS) -> Column:
    return lur > as_column(p.overage_above)


def state(
    grace: Column,
    prior_lur: Column,
    sustained: Column,
    health: Column,
    ever_active: Column,
    speed: Column,
    features: Column,
    score: Column,
    p: ScoreParams = DEFAULTS,
) -> Column:
    """One label per row; the first rule that holds wins. Reads unrounded values."""
    collapsed = (F.coalesce(prior_lur, F.lit(0.0)) >= as_column(p.collapse_prior)) & (
        sustained < as_column(p.collapse_sustained)
    )
    dark = health == F.lit(0.0)
    stalled = (speed < as_column(p.stall_speed)) & (features < as_column(p.stall_features))
    return (
        F.when(grace, v.GRACE)
        .when(collapsed, v.CHURN)
        .when(dark & (ever_active == 1), v.LAPSED)
        .when(dark, v.SHELFWARE)
        .when(stalled, v.STALL)
        .otherwise(band(score, p))
    )


def band(score: Column, p: ScoreParams = DEFAULTS) -> Column:
    """Band of a score, lower bounds inclusive. Dashboards pass the stored, rounded score."""
    return (
        F.when(score >= as_column(p.band_top), v.REALIZED)
        .when(score >= as_column(p.band_middle), v.DEVELOPING)
        .when(score >= as_column(p.band_low), v.AT_RISK)
        .otherwise(v.CRITICAL)
    )


def at_risk(score: Column, p: ScoreParams = DEFAULTS) -> Column:
    """In the At Risk band or below."""
    return score < as_column(p.band_middle)
