"""Data-quality assertions over raw tables and marts.

Every assertion measures one whole number and passes when it equals the
expected one. Assertions on the same table share one aggregate; look-ups of
orphans and sets of accounts first fold the fact table to its keys, so that a
key with very many rows is one row in the join.
"""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from uptake import register, schemas
from uptake import vocabulary as v
from uptake.functions.calendar import day
from uptake.functions.numeric import MONEY, SCORE, exact_mean, exact_sum, rnd
from uptake.operators.contracts import licensed_by_month, overlap_pairs
from uptake.operators.staging import SKU_MONTH, sku_month
from uptake.params import DEFAULTS, ScoreParams, as_column

OVERAGE = 1.2
RISK_STATES = (v.CHURN, v.SHELFWARE, v.LAPSED, v.STALL)


@dataclass(frozen=True)
class Expectations:
    """What a data set is known to contain. The defaults are the fixed values of one pinned data set."""

    first_month: str = "2025-07-01"
    latest_month: str = "2026-06-01"
    months: int = 12
    overlap_pairs: int = 6
    shelfware_accounts: int = 10
    overage_accounts: int = 15
    churn_customers: int = 5
    slow_onboarders: int = 5
    total_rows: int = 5483
    vrs_sum: float = 373804.0
    vrs_tolerance: float = 2.0
    latest_arr_sum: float = 146499822.0
    arr_tolerance: float = 5.0


@dataclass(frozen=True)
class _Check:
    ord: int
    cat: str
    test: str
    expect: int


def _checks(e: Expectations) -> list[_Check]:
    table = [
        ("integrity", "orphan_consumption_customers", 0),
        ("integrity", "orphan_consumption_products", 0),
        ("integrity", "orphan_consumption_entitlements", 0),
        ("integrity", "orphan_feature_adoption_features", 0),
        ("integrity", "sku_month_grain_unique", 0),
        ("integrity", "vrs_within_0_100", 0),
        ("integrity", "components_within_0_1", 0),
        ("integrity", "no_negative_or_zero_license", 0),
        ("integrity", "twelve_months_present", e.months),
        ("integrity", "every_entitlement_has_consumption", 0),
        ("overlap", "overlap_pairs_exist_ge6", e.overlap_pairs),
        ("overlap", "licensed_equals_sum_active_entitlements", 0),
        ("anomaly", "shelfware_accounts_eq_10", e.shelfware_accounts),
        ("anomaly", "shelfware_all_state_shelfware_risk", 0),
        ("anomaly", "overage_accounts_eq_15", e.overage_accounts),
        ("anomaly", "overage_all_raise_expansion_flag", 0),
        ("anomaly", "churn_signal_customers_eq_5", e.churn_customers),
        ("anomaly", "slow_onboarder_accounts_eq_5", e.slow_onboarders),
        ("anomaly", "slow_onboarders_all_hit_onboarding_stall", 0),
        ("anomaly", "partial_ttv_band_exercised", 1),
        ("ground_truth", "normal_no_risk_states_or_expansion", 0),
        ("schema", "customers_schema", len(schemas.CUSTOMERS)),
        ("schema", "products_schema", len(schemas.PRODUCTS)),
        ("schema", "entitlements_schema", len(schemas.ENTITLEMENTS)),
        ("schema", "features_schema", len(schemas.FEATURES)),
        ("schema", "consumption_schema", len(schemas.CONSUMPTION)),
        ("schema", "feature_adoption_schema", len(schemas.FEATURE_ADOPTION)),
        ("schema", "mart_sku_month_schema", len(schemas.SKU_MONTH_ASSERTED)),
        ("unit", "shelfware_scores_zero", 0),
        ("unit", "overage_capped_and_flagged", 0),
        ("unit", "peak_band_scores_one", 0),
        ("unit", "partial_ttv_implies_31_90_days", 0),
        ("regression", "total_rows_stable", e.total_rows),
        ("regression", "vrs_checksum_stable", 0),
        ("regression", "latest_month_arr_stable", 0),
        ("freshness", "latest_month_is_current", 0),
    ]
    return [_Check(i + 1, *row) for i, row in enumerate(table)]


# ---- measurements: frames of (ord, val) -----------------------------------


def _unpivot(row: DataFrame, numbers: Mapping[int, str]) -> DataFrame:
    """One aggregate row with several measurements -> one row per measurement."""
    structs = [
        F.struct(F.lit(number).alias("ord"), F.coalesce(F.col(c).cast("long"), F.lit(0)).alias("val"))
        for number, c in numbers.items()
    ]
    return row.select(F.inline(F.array(*structs)))


def _measured(df: DataFrame, measures: Mapping[int, Column]) -> DataFrame:
    """Several measurements in one aggregate over ``df``."""
    row = df.agg(*[m.alias(f"q{number}") for number, m in measures.items()])
    return _unpivot(row, {number: f"q{number}" for number in measures})


def _one(row: DataFrame, number: int, value: Column) -> DataFrame:
    return row.agg(value.alias("val")).select(
        F.lit(number).alias("ord"), F.coalesce(F.col("val").cast("long"), F.lit(0)).alias("val")
    )


def orphans(facts: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Keys of ``facts`` missing from ``dimension``, with their number of rows.

    ``facts`` may be folded already, with its row counts in ``rows``.
    """
    weight = F.sum("rows") if "rows" in facts.columns else F.count("*")
    return facts.groupBy(key).agg(weight.alias("rows")).join(dimension.select(key), key, "left_anti")


def schema_matches(stored: Sequence[StructType], expected: StructType) -> int:
    """Number of expected columns that every stored schema has with the expected type; 0 where nothing is stored."""
    present = [{f.name: f.dataType for f in s} for s in stored]
    return sum(1 for f in expected if present and all(p.get(f.name) == f.dataType for p in present))


def _consumption_checks(raw: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Everything asked about rows of usage, from one fold to contracts that meets each dimension once."""
    use = raw["consumption"]
    bad = (F.col("consumed_units") < 0) | (F.col("licensed_amount") <= 0)
    by_contract = use.groupBy("cust_id", "product_id", "entitlement_id").agg(
        F.count("*").alias("rows"), F.count_if(bad).alias("bad")
    )

    def known(name: str, key: str) -> DataFrame:
        return raw[name].groupBy(key).agg(F.lit(True).alias(f"known_{key}"))

    def strays(key: str) -> Column:
        # A null key belongs to no dimension either.
        return F.sum(F.when(F.col(f"known_{key}").isNull(), F.col("rows")))

    # One row a contract of usage, and one for each contract without any; the latter have no rows to count.
    held = by_contract.join(known("entitlements", "entitlement_id"), "entitlement_id", "full")
    named = held.join(known("customers", "cust_id"), "cust_id", "left").join(known("products", "product_id"), "product_id", "left")
    measures = {
        1: strays("cust_id"),
        2: strays("product_id"),
        3: strays("entitlement_id"),
        8: F.sum("bad"),
        10: F.count_if(F.col("rows").isNull()),
    }
    return [
        _measured(named, measures),
        _one(orphans(raw["feature_adoption"], raw["features"], "feature_id"), 4, F.sum("rows")),
        # Reads the month alone, of which stored usage may be partitioned.
        _one(use.groupBy("month").count(), 9, F.count("month")),
    ]


def _account_checks(raw: Mapping[str, DataFrame], mart: DataFrame, e: Expectations, p: ScoreParams = DEFAULTS) -> DataFrame:
    """Everything asked about accounts and about rows of the mart, from one row per account.

    Usage, mart and labels are each folded to accounts in one pass and meet in
    one join; the licence of the active contracts is compared on the way. The mart's own
    measures are sums and extremes, so they travel with the same fold.
    """
    active = licensed_by_month(raw["entitlements"], e.first_month, e.latest_month)
    off = F.abs(F.col("licensed_amount") - F.col("lic")) > 0.5
    use = (
        sku_month(raw["consumption"])
        .join(active, SKU_MONTH, "left")
        .groupBy("cust_id")
        .agg(
            F.max(F.abs("consumed_units")).alias("used"),
            exact_mean(F.col("lur")).alias("mean_lur"),
            F.count_if(off).alias("off"),
        )
    )
    growing = F.coalesce("flag_expansion", F.lit(False))
    of_rows, finished = _mart_measures(e, p)
    scored = mart.groupBy("cust_id").agg(
        F.count_if(~F.col("state").isin(v.SHELFWARE, v.GRACE)).alias("other_states"),
        F.bool_or(growing).alias("expanding"),
        F.bool_or(F.col("state") == v.STALL).alias("stalled"),
        F.bool_or(F.col("state") == v.CHURN).alias("churning"),
        F.count_if(F.col("state").isin(*RISK_STATES) | growing).alias("risk_rows"),
        *[measure.alias(name) for name, measure in of_rows.items()],
    )
    # One row an account here too, so that a repeated customer repeats no measure.
    label = F.col("behavior_profile")
    people = raw["customers"].groupBy("cust_id").agg(
        F.count_if(label == "slow_onboarder").alias("slow"), F.count_if(label == "normal").alias("normal")
    )
    accounts = use.join(scored, "cust_id", "full").join(people, "cust_id", "full")

    def holds(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(False))

    silent, heavy = F.col("used") == 0, F.col("mean_lur") > OVERAGE
    measures = {
        12: F.sum("off"),
        13: F.count_if(silent),
        14: F.sum(F.when(silent, F.col("other_states"))),
        15: F.count_if(heavy),
        16: F.count_if(heavy & ~holds("expanding")),
        17: F.count_if("churning"),
        18: F.sum("slow"),
        19: F.sum(F.when(~holds("stalled"), F.col("slow"))),
        21: F.sum(F.col("risk_rows") * F.col("normal")),
        **finished,
    }
    return _measured(accounts, measures)


def _mart_measures(e: Expectations, p: ScoreParams = DEFAULTS) -> tuple[dict[str, Column], dict[int, Column]]:
    """What one fold of the mart keeps for each account, and the measurements made of that over all accounts."""
    lur, health, vrs = F.col("lur"), F.col("util_health"), F.col("vrs")
    speed, days = F.col("ttv_score"), F.col("ttv_days")
    partial = (speed > 0) & (speed < 1)
    over = lur > as_column(p.overage_above)

    def outside(name: str) -> Column:
        # NULL components (grace, no features) are inside by definition.
        return F.coalesce(~F.col(name).between(0, 1), F.lit(False))

    strays = reduce(
        Column.__or__, [outside(c) for c in ("util_health", "feature_adoption", "sustained_usage", "ttv_score")]
    )
    latest = F.col("month") == day(e.latest_month)
    counted = {
        6: (vrs < 0) | (vrs > 100),
        7: strays,
        29: (lur < as_column(p.use_floor)) & (health != 0),
        30: over & ((health != rnd(as_column(p.overage_score), 3)) | ~F.col("flag_expansion")),
        31: (lur >= as_column(p.full_from)) & ~over & (health != rnd(as_column(p.full_score), 3)),
        32: partial & ((days <= as_column(p.fast_days)) | (days > as_column(p.slow_days))),
        33: F.lit(True),
    }
    of_rows = {f"n{number}": F.count_if(test) for number, test in counted.items()}
    of_rows |= {
        "any_partial": F.max(F.when(partial, 1)),
        "vrs_sum": exact_sum(vrs, SCORE),
        "latest_arr": F.sum(F.when(latest, F.col("arr").cast(MONEY))),
        "last_month": F.max("month"),
    }
    finished = {number: F.sum(f"n{number}") for number in counted}
    finished |= {
        20: F.coalesce(F.max("any_partial"), F.lit(0)),
        34: _off(F.sum("vrs_sum"), e.vrs_sum, e.vrs_tolerance),
        35: _off(F.sum("latest_arr"), e.latest_arr_sum, e.arr_tolerance),
        36: F.when(F.max("last_month") == day(e.latest_month), 0).otherwise(1),
    }
    return of_rows, finished


def _off(measured: Column, expected: float, tolerance: float) -> Column:
    """0 when the measured sum lies within the tolerance, else 1 (also for no rows)."""
    return F.when(F.abs(measured.cast("double") - F.lit(expected)) < F.lit(tolerance), 0).otherwise(1)


#: The mart's name among stored schemas.
MART = "mart_customer_sku_month"


def schema_checks(
    raw: Mapping[str, DataFrame], mart: DataFrame, stored: Mapping[str, Sequence[StructType]] | None = None
) -> dict[int, int]:
    """Matching columns per schema assertion.

    ``stored`` has the schemas of each table's files, from ``tables.stored_schemas``. A frame read with
    a fixed schema only shows that schema, so without ``stored`` just frames made in memory are judged.
    """
    known = stored or {name: [df.schema] for name, df in [*raw.items(), (MART, mart)]}
    counts = {22 + i: schema_matches(known[name], s) for i, (name, s) in enumerate(schemas.RAW.items())}
    counts[28] = schema_matches(known[MART], schemas.SKU_MONTH_ASSERTED)
    return counts


# ---- report ---------------------------------------------------------------


def report(
    raw: Mapping[str, DataFrame],
    mart: DataFrame,
    e: Expectations = Expectations(),
    stored: Mapping[str, Sequence[StructType]] | None = None,
    p: ScoreParams = DEFAULTS,
    parameters: DataFrame | None = None,
) -> DataFrame:
    """One row per assertion: cat, test, val, expect, result, in a fixed order. ``stored`` as in ``schema_checks``.

    The rules' own assertions hold the mart against ``p``, or against the resolved register it was built with.
    """
    judged = mart
    if parameters is not None:
        people, things = raw["customers"].select("cust_id", "segment"), raw["products"].select("product_id", "product_platform")
        named = mart.join(people, "cust_id", "left").join(things, "product_id", "left")
        judged, p = register.attach(named, parameters), register.columns()
    matches = [
        F.struct(F.lit(number).alias("ord"), F.lit(n).cast("long").alias("val"))
        for number, n in schema_checks(raw, mart, stored).items()
    ]
    measured = [
        *_consumption_checks(raw),
        _account_checks(raw, judged, e, p),
        _one(mart.groupBy(*SKU_MONTH).count().where(F.col("count") > 1), 5, F.count("*")),
        _one(overlap_pairs(raw["entitlements"]), 11, F.least(F.coalesce(F.sum("pairs"), F.lit(0)), F.lit(e.overlap_pairs))),
        mart.sparkSession.range(1).select(F.inline(F.array(*matches))),
    ]
    checks = F.array(
        *[
            F.struct(
                F.lit(c.cat).alias("cat"), F.lit(c.test).alias("test"), F.lit(c.expect).cast("long").alias("expect")
            )
            for c in _checks(e)
        ]
    )
    rows = reduce(DataFrame.unionByName, measured).withColumn("check", F.element_at(checks, F.col("ord")))
    verdict = F.when(F.col("val") == F.col("check.expect"), "PASS").otherwise("FAIL")
    return rows.orderBy("ord").select("check.cat", "check.test", "val", "check.expect", verdict.alias("result"))


class QualityError(Exception):
    pass


def gate(rows: DataFrame) -> DataFrame:
    """One row for a scheduler: how many assertions passed and failed, which ones failed, and the verdict."""
    bad = F.col("result") != "PASS"
    failed = F.array_sort(F.collect_list(F.when(bad, F.col("test"))))  # of 36 rows
    out = rows.agg(F.count_if(~bad).alias("passed"), F.count_if(bad).alias("failed"), F.array_join(failed, ", ").alias("failed_tests"))
    return out.withColumn("verdict", F.when(F.col("failed") == 0, "PASS").otherwise("FAIL"))


def enforce(rows: DataFrame) -> str:
    """Raises when an assertion failed, else returns a summary. Collects the report's rows."""
    results = rows.collect()
    failed = [r["test"] for r in results if r["result"] != "PASS"]
    if failed:
        raise QualityError(f"{len(failed)} of {len(results)} assertions failed: {', '.join(failed)}")
    return f"{len(results)}/{len(results)} passed"


def pin(mart: DataFrame, e: Expectations = Expectations()) -> Expectations:
    """Expectations with the checksums of a trusted build (one row is collected)."""
    latest = F.col("month") == day(e.latest_month)
    row = mart.agg(
        F.count("*").alias("n"),
        exact_sum(F.col("vrs"), SCORE).cast("double").alias("vrs"),
        exact_sum(F.when(latest, F.col("arr"))).cast("double").alias("arr"),
    ).first()
    return replace(e, total_rows=row["n"], vrs_sum=row["vrs"], latest_arr_sum=row["arr"])


# ---- parity of two builds -------------------------------------------------


def build_parity(left: DataFrame, right: DataFrame) -> DataFrame:
    """Row count, score sum and revenue sum of two builds, with tolerances. Advisory only."""

    def sums(df: DataFrame, side: str) -> DataFrame:
        return df.agg(
            F.count("*").cast("double").alias("rows"),
            exact_sum(F.col("vrs"), SCORE).cast("double").alias("vrs"),
            exact_sum(F.col("arr")).cast("double").alias("arr"),
        ).select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(label).alias("check"), F.col(c).alias(side), F.lit(tol).alias("tolerance"))
                        for label, c, tol in (
                            ("row count", "rows", 0.0),
                            ("score checksum", "vrs", 2.0),
                            ("revenue checksum", "arr", 5.0),
                        )
                    ]
                )
            )
        )

    off = F.abs(F.coalesce("left_value", F.lit(0.0)) - F.coalesce("right_value", F.lit(0.0)))
    return (
        sums(left, "left_value")
        .join(sums(right, "right_value").drop("tolerance"), "check")
        .withColumn("verdict", F.when(off <= F.col("tolerance"), "OK").otherwise("WARNING"))
    )


#: Customers are dealt into so many parts a month when two builds are compared.
PARTS = 1024


def _hashed(df: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    part = F.pmod(F.xxhash64("cust_id"), F.lit(PARTS)).cast("int")
    return df.select(*keys, part.alias("part"), F.xxhash64(*names).cast("decimal(20,0)").alias("hash"))


def _sums(rows: DataFrame, by: Sequence[str], side: str) -> DataFrame:
    """Number and sum of hashes, which do not depend on the order of rows."""
    return rows.groupBy(*by).agg(F.count("*").alias(f"{side}_n"), F.sum("hash").alias(f"{side}_sum"))


def _unequal(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    other = right.withColumnsRenamed({c: f"right_{c}" for c in by})
    pairs = [F.col(c).eqNullSafe(F.col(f"right_{c}")) for c in by]
    joined = left.join(other, reduce(Column.__and__, pairs), "full")
    same = F.col("left_n").eqNullSafe(F.col("right_n")) & F.col("left_sum").eqNullSafe(F.col("right_sum"))
    named = [F.coalesce(c, f"right_{c}").alias(c) for c in by]
    return joined.where(~same).select(*named, "left_n", "right_n")


def build_differences(left: DataFrame, right: DataFrame, keys: Sequence[str] = tuple(SKU_MONTH)) -> DataFrame:
    """The keys at which two builds differ, with the number of rows on each side and ``kind``.

    Both builds are folded to one hash a month and part of the customers. Parts that agree are never joined; of the
    others, only the rows are compared key by key. Columns are those both builds have, by name.
    """
    names = sorted(set(left.columns) & set(right.columns))
    one, two = _hashed(left, keys, names), _hashed(right, keys, names)
    at = ["month", "part"]
    parts = _unequal(_sums(one, at, "left"), _sums(two, at, "right"), at).select(*[F.col(c).alias(f"odd_{c}") for c in at])
    odd = F.col("month").eqNullSafe(F.col("odd_month")) & F.col("part").eqNullSafe(F.col("odd_part"))
    sides = [_sums(rows.join(parts, odd, "left_semi"), keys, side) for rows, side in ((one, "left"), (two, "right"))]
    kind = F.when(F.col("right_n").isNull(), "left only").when(F.col("left_n").isNull(), "right only").otherwise("differs")
    return _unequal(*sides, keys).select(*keys, "left_n", "right_n", kind.alias("kind"))


def difference_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: the rows of both builds, the keys and customers that differ, and the verdict. Advisory only."""
    found = build_differences(left, right).agg(F.count("*").alias("keys"), F.countDistinct("cust_id").alias("customers"))
    verdict = F.when(F.col("keys") == 0, "OK").otherwise("WARNING").alias("verdict")
    rows = [df.agg(F.count("*")).scalar().alias(name) for df, name in ((left, "left_rows"), (right, "right_rows"))]
    return found.select(*rows, "keys", "customers", verdict)


# ---- profile of the source tables -----------------------------------------


def source_profile(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts, label counts, silent and over-using accounts, overlapping pairs."""

    def metric(df: DataFrame, name: Column, value: Column) -> DataFrame:
        return df.agg(value.alias("value")).select(
            name.alias("metric"), F.coalesce(F.col("value").cast("long"), F.lit(0)).alias("value")
        )

    counted = {name: df for name, df in raw.items() if name != "consumption"}
    rows = [metric(df, F.lit(f"rows {name}"), F.count("*")) for name, df in counted.items()]
    label_counts = (
        raw["customers"]
        .groupBy("behavior_profile")
        .agg(F.count("*").alias("value"))
        .select(F.concat(F.lit("label "), "behavior_profile").alias("metric"), "value")
    )
    ratio = F.try_divide("consumed_units", F.col("licensed_amount").cast("double"))
    accounts = (
        raw["consumption"]
        .groupBy("cust_id")
        .agg(
            F.count("*").alias("rows"),
            F.max(F.abs("consumed_units")).alias("used"),
            exact_mean(ratio).alias("mean_lur"),
        )
    )
    usage = accounts.agg(
        F.sum("rows").alias("rows"),
        F.count_if(F.col("used") == 0).alias("silent"),
        F.count_if(F.col("mean_lur") > OVERAGE).alias("heavy"),
    ).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(text).alias("metric"), F.coalesce(F.col(c), F.lit(0)).alias("value"))
                    for text, c in (
                        ("rows consumption", "rows"),
                        ("accounts without use", "silent"),
                        ("accounts above 1.2 on average", "heavy"),
                    )
                ]
            )
        )
    )
    pairs = metric(overlap_pairs(raw["entitlements"]), F.lit("overlapping contract pairs"), F.sum("pairs"))
    return reduce(DataFrame.unionByName, [*rows, label_counts, usage, pairs])
