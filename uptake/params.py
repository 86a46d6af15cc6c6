"""Parameter register: every weight and threshold of the scoring rules."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScoreParams:
    """Fixed values of the metric as defaults. A field may also hold a Column, see ``resolve``."""

    # weights of the four components
    weight_utilization: float | Column = 0.35
    weight_features: float | Column = 0.25
    weight_sustained: float | Column = 0.25
    weight_speed: float | Column = 0.15

    # utilization curve over consumed / licensed
    use_floor: float | Column = 0.10
    healthy_from: float | Column = 0.60
    full_from: float | Column = 1.00
    overage_above: float | Column = 1.20
    ramp_base: float | Column = 0.3
    ramp_slope: float | Column = 1.2
    healthy_base: float | Column = 0.9
    healthy_slope: float | Column = 0.25
    full_score: float | Column = 1.0
    overage_score: float | Column = 0.8

    # recency weights of the trailing three rows
    recency_0: float | Column = 0.5
    recency_1: float | Column = 0.3
    recency_2: float | Column = 0.2

    # days to first value
    fast_days: float | Column = 30.0
    slow_days: float | Column = 90.0

    # graded feature levels, at most three decimals
    feature_idle: float | Column = 0.3
    feature_active: float | Column = 0.7
    feature_deep: float | Column = 1.0

    # state rules and flags
    collapse_prior: float | Column = 0.6
    collapse_sustained: float | Column = 0.34
    stall_speed: float | Column = 0.5
    stall_features: float | Column = 0.3
    fragile_features: float | Column = 0.25
    fragile_utilization: float | Column = 0.9

    # score bands
    band_top: float | Column = 70.0
    band_middle: float | Column = 50.0
    band_low: float | Column = 30.0

    def grades_vary(self) -> bool:
        """Whether the feature levels depend on columns."""
        return any(isinstance(x, Column) for x in (self.feature_idle, self.feature_active, self.feature_deep))

    def with_values(self, **values: float) -> ScoreParams:
        return replace(self, **values)


DEFAULTS = ScoreParams()

#: Ramp from zero instead of the step at the use floor.
SMOOTH_ACTIVATION = DEFAULTS.with_values(ramp_base=0.0, ramp_slope=1.8)

#: Harsher ceiling for accounts beyond their licence.
HARSH_OVERAGE = DEFAULTS.with_values(overage_score=0.60)


@dataclass(frozen=True)
class Override:
    """Values that replace the defaults for one segment and/or platform."""

    values: Mapping[str, float] = field(default_factory=dict)
    segment: str | None = None
    platform: str | None = None

    def applies(self) -> Column:
        test = F.lit(True)
        if self.segment is not None:
            test = test & F.col("segment").eqNullSafe(self.segment)
        if self.platform is not None:
            test = test & F.col("product_platform").eqNullSafe(self.platform)
        return test


def resolve(overrides: list[Override], base: ScoreParams = DEFAULTS) -> ScoreParams:
    """Parameters as Columns over ``segment`` and ``product_platform``.

    The first override that matches a row and names the parameter wins. The
    rules are literals in the plan, so scoring with them adds no join.
    """
    known = {f.name for f in fields(ScoreParams)}
    changed: dict[str, Column] = {}
    for name in sorted({n for o in overrides for n in o.values}):
        if name not in known:
            raise ValueError(f"unknown parameter: {name}")
        rules = [o for o in overrides if name in o.values]
        chain = F.when(rules[0].applies(), F.lit(float(rules[0].values[name])))
        for rule in rules[1:]:
            chain = chain.when(rule.applies(), F.lit(float(rule.values[name])))
        changed[name] = chain.otherwise(as_column(getattr(base, name)))
    return replace(base, **changed)


def as_column(value: float | Column) -> Column:
    """A parameter as a double Column (a bare 0.3 in SQL text would be a decimal)."""
    return value if isinstance(value, Column) else F.lit(float(value))
