"""Staging, components and marts on hand-made books."""

import datetime as dt

import pytest

from tests.fixtures import CALENDAR, Book, d, mart_rows, one_sku
from uptake import schemas
from uptake import vocabulary as v
from uptake.operators import components, staging
from uptake.plans import marts
from uptake.sources.tables import conform


def sustained(spark, actives):
    rows = mart_rows(spark, one_sku(spark, actives))
    return rows[-1]["sustained_usage"]


@pytest.mark.parametrize(
    ("history", "expected"),
    [
        ("1", 1.0), ("0", 0.0), ("10", 0.375), ("01", 0.625), ("110", 0.5),
        ("100", 0.2), ("001", 0.5), ("101", 0.7), ("111", 1.0),
    ],
)
def test_sustained_usage(spark, history, expected):
    assert sustained(spark, [int(c) for c in history]) == expected


def test_overlapping_contracts_are_summed_before_dividing(spark):
    book = Book(spark)
    one, two = book.contract("C1", "P1", licence=100), book.contract("C1", "P1", licence=160)
    book.use(one, "C1", "P1", CALENDAR[:1], [80], 100)
    book.use(two, "C1", "P1", CALENDAR[:1], [80], 160)
    row = staging.sku_month(book.raw()["consumption"]).first()
    assert (row.licensed_amount, row.consumed_units) == (260, 160.0)
    assert row.lur == pytest.approx(0.6153846, abs=1e-7)


def test_events_are_summed_before_grading(spark):
    book = Book(spark)
    book.feature("F1", "P1", floor=20, deep=80)
    one, two = book.contract("C1", "P1"), book.contract("C1", "P1")
    book.events(one, "C1", "P1", "F1", CALENDAR[:1], [15])
    book.events(two, "C1", "P1", "F1", CALENDAR[:1], [10])
    raw = book.raw()
    row = staging.feature_month(raw["feature_adoption"], raw["features"]).first()
    assert (row.usage_events, row.feature_score) == (25, 0.7)
    label = marts.customer_feature_month(raw).first()
    assert label.adoption_level == "active"


def test_spike_and_drop(spark):
    rows = mart_rows(spark, one_sku(spark, [3, 3, 3, 0, 0, 0, 0]))
    assert [r["state"] for r in rows[3:]] == [v.LAPSED, v.CHURN, v.CHURN, v.LAPSED]
    assert [r["sustained_usage"] for r in rows[3:]] == [0.5, 0.2, 0.0, 0.0]
    assert all(r["flag_expansion"] for r in rows[:3])


def test_never_active(spark):
    rows = mart_rows(spark, one_sku(spark, [0, 0, 0]))
    assert [r["state"] for r in rows] == [v.GRACE, v.SHELFWARE, v.SHELFWARE]
    assert [r["ttv_score"] for r in rows] == [None, 0.0, 0.0]
    assert {r["ttv_days"] for r in rows} == {None}


def test_slow_onboarder(spark):
    book = one_sku(spark, [0, 0, 0.2])
    for n in range(2, 4):
        book.feature(f"F{n}", "P1")
    book.events("E00001", "C1", "P1", "F1", CALENDAR[:3], [0, 0, 5])
    for n in range(2, 4):
        book.events("E00001", "C1", "P1", f"F{n}", CALENDAR[:3], [0, 0, 0])
    rows = mart_rows(spark, book)
    assert [r["state"] for r in rows] == [v.GRACE, v.SHELFWARE, v.STALL]
    assert rows[2]["feature_adoption"] == 0.1
    assert rows[2]["ttv_score"] == 0.467


def test_mid_month_start_counts_negative_days(spark):
    rows = mart_rows(spark, one_sku(spark, [1.0], start="2025-07-15"))
    assert (rows[0]["ttv_days"], rows[0]["ttv_score"]) == (-14, 1.0)


def test_product_without_features(spark):
    rows = mart_rows(spark, one_sku(spark, [0, 0.6], features=False))
    assert [r["feature_adoption"] for r in rows] == [None, None]
    assert rows[0]["vrs"] == 0.0  # grace, weights 0.60
    # weights 0.75: (0.35 * 0.9 + 0.25 * 0.625 + 0.15 * 59/60) / 0.75
    assert rows[1]["vrs"] == 82.5
    assert rows[1]["flag_single_feature_dependency"] is False


def test_features_without_rows_score_zero(spark):
    rows = mart_rows(spark, one_sku(spark, [1.0]))
    assert rows[0]["feature_adoption"] == 0.0
    assert rows[0]["flag_single_feature_dependency"] is True
    assert rows[0]["state"] == v.DEVELOPING or rows[0]["state"] == v.REALIZED


def test_zero_licence(spark):
    book = one_sku(spark, [0.5, 0.5, 0.5], licence=0)
    rows = mart_rows(spark, book)
    assert [(r["lur"], r["util_health"], r["sustained_usage"], r["vrs"]) for r in rows] == [(None, 0.8, None, None)] * 3
    # never a known use: time to value 0 and no features used
    assert {r["state"] for r in rows} == {v.STALL}


def test_zero_licence_after_use_is_critical(spark):
    book = one_sku(spark, [1.0, 1.0, 1.0])
    book.use("E00001", "C1", "P1", [CALENDAR[3]], [50], 0)
    rows = mart_rows(spark, book)
    assert rows[3]["state"] == v.CRITICAL
    assert rows[3]["ever_active_before"] == 1


def test_windows_count_rows_not_months(spark):
    months = [d("2025-07-01"), d("2025-08-01"), d("2025-10-01")]
    rows = mart_rows(spark, one_sku(spark, [1, 0, 1], months=months))
    assert rows[-1]["sustained_usage"] == 0.7


def test_prior_mean_excludes_the_current_row(spark):
    book = one_sku(spark, [0.2, 0.4, 0.6, 0.8, 0.1])
    raw = book.raw()
    fa = staging.feature_adoption_avg(staging.feature_month(raw["feature_adoption"], raw["features"]))
    rows = components.sku_components(staging.sku_month(raw["consumption"]), fa).orderBy("month").collect()
    assert [r.prior_lur for r in rows] == [None] + [pytest.approx(x) for x in (0.2, 0.3, 0.4, 0.6)]
    assert [r.ever_active_before for r in rows] == [0, 1, 1, 1, 1]


def test_revenue_counts_all_contracts_in_every_month(spark):
    book = one_sku(spark, [1.0] * 8)
    book.contract("C1", "P1", start="2026-01-01", arr=500.0, expansion=True)
    assert {r["arr"] for r in mart_rows(spark, book)} == {1500.0}


def test_months_without_a_contract_are_dropped(spark):
    book = one_sku(spark, [1.0])
    book.use("E9", "C9", "P1", CALENDAR[:1], [10])
    assert [r["cust_id"] for r in mart_rows(spark, book)] == ["C1"]


def _mart(spark, rows):
    defaults = dict.fromkeys(schemas.SKU_MONTH.names)
    defaults |= {"product_id": "P1", "month": CALENDAR[0], "state": v.REALIZED}
    full = [tuple((defaults | row)[n] for n in schemas.SKU_MONTH.names) for row in rows]
    return spark.createDataFrame(full, schemas.SKU_MONTH)


def test_roll_ups(spark):
    mart = _mart(
        spark,
        [
            {"cust_id": "C1", "vrs": 90.0, "arr": 900.0},
            {"cust_id": "C1", "product_id": "P2", "vrs": 20.0, "arr": 50.0},
            {"cust_id": "C2", "vrs": 10.0, "arr": 0.0},
        ],
    )
    book = Book(spark)
    for c in ("C1", "C2"):
        book.customer(c)
    book.product("P1")
    raw = book.raw()
    one, two = marts.customer_month(mart, raw["customers"]).orderBy("cust_id").collect()
    assert (one.vrs_arr_weighted, one.vrs_simple_avg, one.total_arr, one.arr_at_risk, one.skus) == (86.3, 55.0, 950, 50, 2)
    assert two.vrs_arr_weighted is None
    product = marts.product_month(mart, raw["products"]).collect()
    assert [(p.vrs_arr_weighted, p.total_arr, p.customers) for p in product] == [(90.0, 900.0, 2)]


def test_build_matches_the_schemas(spark):
    book = one_sku(spark, [1.0, 0.5], events=[10, 90])
    for name, df in marts.build(book.raw()).items():
        if name in schemas.MARTS:
            want = schemas.MARTS[name]
            assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in want], name
            assert df.schema.names == conform(df, want).schema.names
        assert df.count() > 0


def test_first_signal_may_be_a_feature_event(spark):
    book = one_sku(spark, [0, 0, 0, 1.0], events=[0, 5, 0, 0])
    late, early = (mart_rows(spark, book, from_features=x)[-1] for x in (False, True))
    assert (late["ttv_days"], early["ttv_days"]) == ((dt.date(2025, 10, 1) - dt.date(2025, 7, 1)).days, 31)


def test_parameters_reach_every_component(spark):
    from uptake.params import DEFAULTS, Override

    def book():
        return one_sku(spark, [1.0], events=[10])

    plain, = mart_rows(spark, book())
    generous, = mart_rows(spark, book(), p=DEFAULTS.with_values(feature_idle=0.5))
    assert (plain["feature_adoption"], generous["feature_adoption"]) == (0.3, 0.5)
    rules = [Override({"feature_idle": 0.4, "weight_speed": 0.0}, segment="Enterprise"), Override({"feature_idle": 0.9})]
    varied, = marts.customer_sku_month_overridden(book().raw(), rules).collect()
    assert varied["feature_adoption"] == 0.4
    # (0.35 + 0.25 * 0.4 + 0.25) / 0.85
    assert varied["vrs"] == 82.4


def test_units_keep_six_decimals(spark):
    book = one_sku(spark, [])
    book.use("E00001", "C1", "P1", CALENDAR[:1] * 2, [0.123456, 0.000004])
    assert staging.sku_month(book.raw()["consumption"]).first().consumed_units == 0.12346
