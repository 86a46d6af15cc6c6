"""The assertions pass on a sound book and fail on a broken one."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CALENDAR, Book
from uptake.plans import marts, quality
from uptake.plans.quality import Expectations


def sound_book(spark):
    """Two normal, one silent, one over-using, one collapsing and one slow account."""
    book = Book(spark)
    book.product("P1")
    book.feature("F1", "P1")
    ratios = {
        "C1": ("normal", [0.8] * 12),
        "C2": ("normal", [0.9] * 12),
        "C3": ("shelfware", [0.0] * 12),
        "C4": ("overage", [1.5] * 12),
        "C5": ("spike_drop", [3.0] * 3 + [0.0] * 9),
        "C6": ("slow_onboarder", [0.0, 0.0] + [0.2] * 10),
    }
    for cust, (profile, series) in ratios.items():
        book.customer(cust, profile=profile)
        key = book.contract(cust, "P1")
        book.use(key, cust, "P1", CALENDAR, [100 * r for r in series])
        events = [0 if profile in ("shelfware", "slow_onboarder") else 90] * 12
        book.events(key, cust, "P1", "F1", CALENDAR, events)
    extra = book.contract("C1", "P1", start="2026-01-01", licence=50, expansion=True)
    book.use(extra, "C1", "P1", CALENDAR[6:], [40] * 6, 50)
    return book


EXPECT = Expectations(
    overlap_pairs=1, shelfware_accounts=1, overage_accounts=1, churn_customers=1, slow_onboarders=1
)


@pytest.fixture(scope="module")
def sound(spark):
    raw = {name: df.cache() for name, df in sound_book(spark).raw().items()}
    mart = marts.customer_sku_month(raw).cache()
    return raw, mart, quality.pin(mart, EXPECT)


def results(raw, mart, expect):
    return {r.test: r for r in quality.report(raw, mart, expect).collect()}


def test_sound_book_passes(sound):
    rows = quality.report(*sound).collect()
    assert [r.test for r in rows if r.result != "PASS"] == []
    assert len(rows) == 36
    assert quality.enforce(quality.report(*sound)) == "36/36 passed"
    cats = [r.cat for r in rows]
    order = ["integrity", "overlap", "anomaly", "ground_truth", "schema", "unit", "regression", "freshness"]
    assert [cats.count(c) for c in order] == [10, 2, 8, 1, 7, 4, 3, 1]
    assert sorted(cats, key=order.index) == cats


def _consumption_row(raw, **change):
    one = raw["consumption"].limit(1)
    return {**raw, "consumption": raw["consumption"].unionByName(one.withColumns({k: F.lit(x) for k, x in change.items()}))}


@pytest.mark.parametrize(
    ("change", "test"),
    [
        ({"cust_id": "X"}, "orphan_consumption_customers"),
        ({"product_id": "X"}, "orphan_consumption_products"),
        ({"entitlement_id": "X"}, "orphan_consumption_entitlements"),
        ({"licensed_amount": 0}, "no_negative_or_zero_license"),
        ({"consumed_units": -1.0}, "no_negative_or_zero_license"),
    ],
)
def test_bad_consumption_rows(sound, change, test):
    raw, mart, expect = sound
    change = {k: (int(x) if k == "licensed_amount" else x) for k, x in change.items()}
    broken = _consumption_row(raw, **change)
    broken["consumption"] = broken["consumption"].withColumn("licensed_amount", F.col("licensed_amount").cast("long"))
    row = results(broken, mart, expect)[test]
    assert (row.val, row.result) == (1, "FAIL")


def test_other_broken_sources(sound):
    raw, mart, expect = sound
    use, events = raw["consumption"], raw["feature_adoption"]
    broken = {
        **raw,
        "feature_adoption": events.unionByName(events.limit(2).withColumn("feature_id", F.lit("X"))),
        "consumption": use.where(F.col("month") != F.lit(dt.date(2025, 9, 1)))
        .where(F.col("entitlement_id") != "E00007")
        .withColumn(
            "licensed_amount",
            F.when(F.col("consumption_id") == use.agg(F.min("consumption_id")).first()[0], F.col("licensed_amount") + 1)
            .otherwise(F.col("licensed_amount")),
        ),
    }
    got = results(broken, mart, expect)
    assert (got["orphan_feature_adoption_features"].val, got["orphan_feature_adoption_features"].result) == (2, "FAIL")
    assert got["twelve_months_present"].val == 11
    assert got["licensed_equals_sum_active_entitlements"].result == "FAIL"
    no_use = {**raw, "consumption": use.where(F.col("cust_id") != "C2")}
    assert results(no_use, mart, expect)["every_entitlement_has_consumption"].val == 1


def test_broken_mart(sound):
    raw, mart, expect = sound
    one = mart.where("cust_id = 'C1'").limit(1)
    broken = (
        mart.unionByName(one.withColumn("vrs", F.lit(101.0)))
        .unionByName(one.withColumn("product_id", F.lit("P9")).withColumn("ttv_score", F.lit(1.2)))
        .unionByName(one.withColumn("product_id", F.lit("P8")).withColumn("lur", F.lit(1.2)).withColumn("util_health", F.lit(0.8)))
        .withColumn("state", F.when(F.col("cust_id") == "C3", "Lapsed").otherwise(F.col("state")))
    )
    got = results(raw, broken, expect)
    for test, val in {
        "sku_month_grain_unique": 1,
        "vrs_within_0_100": 1,
        "components_within_0_1": 1,
        "peak_band_scores_one": 1,
        "shelfware_all_state_shelfware_risk": 12,
        "total_rows_stable": 75,
    }.items():
        assert (got[test].val, got[test].result) == (val, "FAIL"), test
    with pytest.raises(quality.QualityError, match="sku_month_grain_unique"):
        quality.enforce(quality.report(raw, broken, expect))


def test_changed_type_and_missing_column(sound):
    raw, mart, expect = sound
    broken = {
        **raw,
        "entitlements": raw["entitlements"].withColumn("unit_price", F.col("unit_price").cast("string")),
    }
    got = results(broken, mart.drop("ttv_days").withColumn("ttv_days", F.lit(1)).withColumn("lur", F.col("lur").cast("float")), expect)
    assert (got["entitlements_schema"].val, got["mart_sku_month_schema"].val) == (9, 12)


def test_undetected_anomalies(sound):
    raw, mart, expect = sound
    blind = mart.withColumn("flag_expansion", F.lit(False)).withColumn("state", F.lit("Developing"))
    got = results(raw, blind, expect)
    for test in (
        "overage_all_raise_expansion_flag",
        "churn_signal_customers_eq_5",
        "slow_onboarders_all_hit_onboarding_stall",
        "overage_capped_and_flagged",
    ):
        assert got[test].result == "FAIL", test
    noisy = mart.withColumn("flag_expansion", F.lit(True))
    assert results(raw, noisy, expect)["normal_no_risk_states_or_expansion"].val == 24


def test_empty_mart_fails_checksums(sound):
    raw, mart, expect = sound
    got = results(raw, mart.where("false"), expect)
    for test in ("total_rows_stable", "vrs_checksum_stable", "latest_month_arr_stable", "latest_month_is_current"):
        assert got[test].result == "FAIL", test


def test_parity(sound):
    _, mart, _ = sound
    same = quality.build_parity(mart, mart).collect()
    assert {r.verdict for r in same} == {"OK"}
    less = {r.check: r.verdict for r in quality.build_parity(mart, mart.where("cust_id <> 'C4'")).collect()}
    assert less == {"row count": "WARNING", "score checksum": "WARNING", "revenue checksum": "WARNING"}


def test_profile(sound):
    raw, _, _ = sound
    got = {r.metric: r.value for r in quality.source_profile(raw).collect()}
    assert got["rows consumption"] == 78
    assert got["label normal"] == 2
    assert (got["accounts without use"], got["accounts above 1.2 on average"], got["overlapping contract pairs"]) == (1, 1, 1)


def test_differences_name_their_keys(spark):
    left = marts.customer_sku_month(sound_book(spark).raw()).persist()
    assert quality.build_differences(left, left.repartition(3)).count() == 0
    assert [tuple(r) for r in quality.difference_report(left, left).select("keys", "verdict").collect()] == [(0, "OK")]
    row = left.orderBy("cust_id", "product_id", "month").first()
    at = (F.col("cust_id") == row.cust_id) & (F.col("product_id") == row.product_id) & (F.col("month") == F.lit(row.month))
    key = (row.cust_id, row.product_id, row.month)
    cases = {
        "differs": (left.withColumn("arr", F.when(at, F.col("arr") + 1).otherwise(F.col("arr"))), (1, 1)),
        "left only": (left.where(~at), (1, None)),
    }
    for kind, (right, n) in cases.items():
        assert [tuple(r) for r in quality.build_differences(left, right).collect()] == [(*key, *n, kind)]
    assert [r.kind for r in quality.build_differences(left.where(~at), left).collect()] == ["right only"]
    twice = quality.build_differences(left, left.unionByName(left.where(at))).collect()
    assert [(r.left_n, r.right_n, r.kind) for r in twice] == [(1, 2, "differs")]
    assert quality.difference_report(left, cases["differs"][0]).first().verdict == "WARNING"
