"""The headline mart, its roll-ups and its denormalised forms."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake import register, schemas
from uptake.functions import scoring
from uptake.functions.numeric import SCORE, exact_sum, ratio, rnd, rnd_signed, total_where, weighted_mean
from uptake.operators import components, contracts, staging
from uptake.operators.staging import SKU
from uptake.params import DEFAULTS, Override, ScoreParams, resolve

Raw = Mapping[str, DataFrame]


# ---- time to value --------------------------------------------------------


def first_value_month(stg_sku_month: DataFrame, p: ScoreParams = DEFAULTS) -> DataFrame:
    """First month of meaningful use per SKU; SKUs never used have no row."""
    return (
        stg_sku_month.where(scoring.in_use(F.col("lur"), p) == 1)
        .groupBy(*SKU)
        .agg(F.min("month").alias("first_value_month"))
    )


def time_to_value(entitlements: DataFrame, first_value: DataFrame, p: ScoreParams = DEFAULTS) -> DataFrame:
    """Days from contract start to first value and their score, per SKU."""
    days = F.datediff("first_value_month", "start_date")
    return (
        contracts.ent_start(entitlements)
        .join(first_value, SKU, "left")
        .select(*SKU, "arr", "start_date", days.alias("ttv_days"), scoring.speed_score(days, p).alias("ttv_score"))
    )


# ---- headline mart --------------------------------------------------------


def sku_side(raw: Raw) -> DataFrame:
    """What contracts and features say of a SKU: its start, revenue and whether it has features."""
    bearing = raw["features"].select("product_id").distinct().withColumn("has_features", F.lit(True))
    return contracts.ent_start(
        raw["entitlements"].join(bearing, "product_id", "left"),
        F.bool_or(F.coalesce("has_features", F.lit(False))).alias("has_features"),
    )


def scored_sku_months(
    raw: Raw,
    p: ScoreParams = DEFAULTS,
    with_attributes: bool = False,
    from_features: bool = False,
    parameters: DataFrame | None = None,
) -> DataFrame:
    """Every score input and the unrounded composite, one row per SKU and month.

    The per-SKU side (start, revenue, has_features) is finished before it meets
    the monthly rows, so a look-up that has to shuffle moves contracts, not
    SKU-months.
    The first month of value comes from the window the components need anyway.
    ``with_attributes`` adds segment and platform for parameters that depend on
    them; ``from_features`` lets a feature event count as first value, too. ``parameters``
    is a resolved register: facts are folded first, then meet their SKU's side, which carries the attributes, once.
    """
    skus = sku_side(raw)
    stg, events, attributes = staging.sku_month(raw["consumption"]), raw["feature_adoption"], ()
    if parameters is not None:
        p = register.columns()
        traits = register.sku_traits(raw)
        rows = register.attach(stg.join(skus, SKU).join(traits, SKU, "left"), parameters)
        graded = _graded(raw, parameters)
        return scored(components.with_history(rows, staging.feature_adoption_avg(graded), p), p, F.col("first_value_month"))
    if with_attributes:
        skus = skus.join(raw["customers"].select("cust_id", "segment"), "cust_id", "left").join(
            raw["products"].select("product_id", "product_platform"), "product_id", "left"
        )
        traits = skus.select(*SKU, "segment", "product_platform")
        stg, skus = stg.join(traits, SKU, "left"), skus.drop("segment", "product_platform")
        if p.grades_vary():
            events, attributes = events.join(traits, SKU, "left"), ("segment", "product_platform")
    graded = staging.feature_month(events, raw["features"], p, attributes)
    rows = components.with_history(stg, staging.feature_adoption_avg(graded), p).join(skus, SKU)
    first = F.col("first_value_month")
    if from_features:
        seen = events.where(F.col("usage_events") > 0).groupBy(*SKU).agg(F.min("month").alias("first_event"))
        rows = rows.join(seen, SKU, "left")
        first = F.least("first_value_month", "first_event")
    return scored(rows, p, first)


def _graded(raw: Raw, parameters: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Graded feature months under a resolved register."""
    folded = staging.feature_events(raw["feature_adoption"])
    return staging.grade(register.attach(folded.join(register.sku_traits(raw), SKU, "left"), parameters), raw["features"], register.columns(), keep)


def scored(rows: DataFrame, p: ScoreParams, first: Column) -> DataFrame:
    """Days to the month ``first``, grace and the composite, added to rows that have the other components."""
    rows = rows.withColumn("ttv_days", F.datediff(first, "start_date"))
    rows = rows.withColumns(
        {
            "ttv_score": scoring.speed_score(F.col("ttv_days"), p),
            "grace": scoring.in_grace(F.col("start_date"), F.col("month"), F.col("util_health")),
        }
    )
    return rows.withColumn(
        "vrs",
        scoring.composite(
            F.col("util_health"),
            F.col("feature_adoption"),
            F.col("sustained_usage"),
            F.col("ttv_score"),
            F.col("has_features"),
            F.col("grace"),
            p,
        ),
    )


def customer_sku_month(raw: Raw, p: ScoreParams = DEFAULTS, **options) -> DataFrame:
    """The headline mart. Flags and state read unrounded values, columns are rounded."""
    shown = p if options.get("parameters") is None else register.columns()
    return present(scored_sku_months(raw, p, **options), shown)


def present(scored: DataFrame, p: ScoreParams = DEFAULTS) -> DataFrame:
    flags = scored.withColumns(
        {
            "flag_single_feature_dependency": scoring.fragile(
                F.col("has_features"), F.col("feature_adoption"), F.col("lur"), p
            ),
            "flag_expansion": scoring.expanding(F.col("lur"), p),
            "state": scoring.state(
                F.col("grace"),
                F.col("prior_lur"),
                F.col("sustained_usage"),
                F.col("util_health"),
                F.col("ever_active_before"),
                F.col("ttv_score"),
                F.col("feature_adoption"),
                F.col("vrs"),
                p,
            ),
        }
    )
    shown = {
        "lur": rnd_signed(F.col("lur"), 3),
        "util_health": rnd(F.col("util_health"), 3),
        "feature_adoption": F.when(F.col("has_features"), rnd(F.col("feature_adoption"), 3)),
        "sustained_usage": rnd(F.col("sustained_usage"), 3),
        "ttv_score": F.when(~F.coalesce("grace", F.lit(False)), rnd(F.col("ttv_score"), 3)),
        "vrs": rnd(F.col("vrs"), 1),
    }
    return flags.select(*[shown.get(f.name, F.col(f.name)).alias(f.name) for f in schemas.SKU_MONTH])


def customer_sku_month_overridden(raw: Raw, overrides: list[Override], p: ScoreParams = DEFAULTS) -> DataFrame:
    """The mart with parameters that vary by segment and platform."""
    return customer_sku_month(raw, resolve(overrides, p), with_attributes=True)


def customer_feature_month(raw: Raw, p: ScoreParams = DEFAULTS, parameters: DataFrame | None = None) -> DataFrame:
    if parameters is not None:
        p = register.columns()
        graded = _graded(raw, parameters, tuple(f"param_{n}" for n in register.NAMES))
    else:
        graded = staging.feature_month(raw["feature_adoption"], raw["features"], p)
    return graded.withColumn("adoption_level", scoring.adoption_level(F.col("feature_score"), p)).select(
        *schemas.FEATURE_MONTH.names
    )


# ---- roll-ups -------------------------------------------------------------


def _roll_up(p: ScoreParams = DEFAULTS) -> list[Column]:
    vrs, arr = F.col("vrs"), F.col("arr")
    return [
        rnd(weighted_mean(vrs, arr), 1).alias("vrs_arr_weighted"),
        rnd(exact_sum(arr).cast("double"), 0).alias("total_arr"),
        rnd(total_where(scoring.at_risk(vrs, p), arr), 0).alias("arr_at_risk"),
    ]


def customer_month(sku_month: DataFrame, customers: DataFrame, p: ScoreParams = DEFAULTS) -> DataFrame:
    """Aggregated first, named second: the join moves customer-months, not SKU-months. ``p`` may read columns of ``sku_month``."""
    plain = ratio(exact_sum(F.col("vrs"), SCORE), F.count("vrs"))
    return (
        sku_month.groupBy("cust_id", "month")
        .agg(*_roll_up(p), rnd(plain, 1).alias("vrs_simple_avg"), F.count("*").alias("skus"))
        .join(customers, "cust_id")
        .select(*schemas.CUSTOMER_MONTH.names)
    )


def product_month(sku_month: DataFrame, products: DataFrame, p: ScoreParams = DEFAULTS) -> DataFrame:
    """The mart has one row a customer, product and month (assertion ``sku_month_grain_unique``), so a product's rows of a month
    are its customers: counting them folds before the exchange, where a distinct count would move every row."""
    return (
        sku_month.groupBy("product_id", "month")
        .agg(*_roll_up(p), F.count("cust_id").alias("customers"))
        .join(products, "product_id")
        .select(*schemas.PRODUCT_MONTH.names)
    )


# ---- denormalised forms ---------------------------------------------------


def sku_month_full(sku_month: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """SKU mart with the names and attributes dashboards filter by."""
    who = customers.select("cust_id", "cust_name", "segment", "region")
    what = products.select("product_id", "product_name", "product_platform")
    return sku_month.join(who, "cust_id").join(what, "product_id").select(*schemas.SKU_MONTH_FULL.names)


def feature_full(feature_month: DataFrame) -> DataFrame:
    return feature_month.select(*schemas.FEATURE_FULL.names)


# ---- the whole build ------------------------------------------------------


def build(raw: Raw, p: ScoreParams = DEFAULTS) -> dict[str, DataFrame]:
    """All staging views and marts as lazy frames, in dependency order."""
    stg_sku = staging.sku_month(raw["consumption"])
    stg_feature = staging.feature_month(raw["feature_adoption"], raw["features"], p)
    sku = customer_sku_month(raw, p)
    feature = customer_feature_month(raw, p)
    return {
        "stg_sku_month": stg_sku,
        "stg_feature_month": stg_feature,
        "int_sku_components": components.sku_components(stg_sku, staging.feature_adoption_avg(stg_feature), p),
        "mart_customer_sku_month": sku,
        "mart_customer_feature_month": feature,
        "mart_customer_month": customer_month(sku, raw["customers"]),
        "mart_product_month": product_month(sku, raw["products"]),
        "mart_sku_month_full": sku_month_full(sku, raw["customers"], raw["products"]),
        "mart_feature_full": feature_full(feature),
    }
