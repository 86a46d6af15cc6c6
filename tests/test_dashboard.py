"""Portfolio, account and product queries on a small denormalised mart."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import CALENDAR
from uptake import schemas
from uptake import vocabulary as v
from uptake.operators.filters import Filters
from uptake.plans import customers, extensions, portfolio, products

JUL, AUG, SEP, OCT = CALENDAR[:4]


def row(cust, month, vrs, arr, **more):
    values = dict.fromkeys(schemas.SKU_MONTH_FULL.names) | {
        "cust_id": cust,
        "cust_name": f"Name {cust}",
        "segment": "Enterprise",
        "region": "AMER",
        "product_id": "P1",
        "product_name": "Alpha SKU-0001",
        "product_platform": "sase",
        "month": month,
        "vrs": vrs,
        "arr": float(arr),
        "lur": 0.8,
        "util_health": 0.95,
        "feature_adoption": 0.5,
        "sustained_usage": 1.0,
        "ttv_score": 1.0,
        "ever_active_before": 1,
        "flag_expansion": False,
        "flag_single_feature_dependency": False,
        "state": v.REALIZED,
    }
    return tuple((values | more)[n] for n in schemas.SKU_MONTH_FULL.names)


OTHER = {"product_id": "P2", "product_name": "Beta SKU-0002", "product_platform": "cloud_ngfw"}
ROWS = [
    row("C1", JUL, 80.0, 100),
    row("C1", AUG, 82.0, 100),
    row("C1", SEP, 84.0, 100),
    row("C1", OCT, 60.0, 100, lur=1.455, flag_expansion=True, state=v.DEVELOPING),
    row("C1", OCT, 40.0, 300, ttv_score=None, feature_adoption=None, **OTHER),
    row("C2", JUL, 20.0, 50, state=v.SHELFWARE, segment="Mid-Market"),
    row("C2", OCT, 25.0, 50, state=v.SHELFWARE, segment="Mid-Market", flag_single_feature_dependency=True),
    row("C3", SEP, 75.0, 0, state=v.LAPSED),
    row("C3", OCT, 72.0, 0, state=v.LAPSED, flag_expansion=None),
    row("C4", OCT, None, 10, lur=None, state=v.CRITICAL),
    row("C5", SEP, 90.0, 10),
    row("C5", OCT, 71.0, 10),
]


@pytest.fixture(scope="module")
def full(spark):
    return spark.createDataFrame(ROWS, schemas.SKU_MONTH_FULL).cache()


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_calendar(full):
    assert [r.month for r in portfolio.months(full).collect()] == ["2025-07", "2025-08", "2025-09", "2025-10"]
    assert one(portfolio.latest_month(full)) == {"month": OCT}
    back = full.limit(1).select(
        portfolio.month_before(full, "2025-10-01", 1).alias("a"),
        portfolio.month_before(full, "2025-10-01", 3).alias("b"),
        portfolio.month_before(full, "2025-08-01", 3).alias("c"),
    )
    assert tuple(back.first()) == (SEP, JUL, None)


def test_filters(full):
    def customers_of(f):
        return {r.cust_id for r in portfolio.snapshot(full, "2025-10-01", f).collect()}

    assert customers_of(Filters()) == {"C1", "C2", "C3", "C4", "C5"}
    assert customers_of(Filters(segments=("Mid-Market",))) == {"C2"}
    assert customers_of(Filters(platforms=("cloud_ngfw",), regions=("AMER", "EMEA"))) == {"C1"}
    assert customers_of(Filters(regions=("EMEA",))) == set()


def test_kpis(full):
    # scored revenue 460: 60*100 + 40*300 + 25*50 + 71*10 = 19960; the unscored 10 stay in the weights
    assert one(portfolio.portfolio_kpis(full, "2025-10-01")) == {
        "vrs": 42.5,
        "arr": 470.0,
        "at_risk_arr": 350.0,
        "customers_at_risk": 4,  # C1 45.0, C2 25.0, C3 and C4 without weight or score count as 0
        "skus_at_risk": 2,
        "customers": 5,
        "expansion_arr": 100.0,
        "expansion_customers": 1,
    }


def test_kpi_movement_uses_positions_of_the_whole_calendar(full):
    rows = {r.month: r for r in portfolio.kpi_movement(full).collect()}
    assert rows[AUG].vrs_mom == 22.0  # 82 against (80*100 + 20*50) / 150 = 60
    assert rows[OCT].vrs_qoq == pytest.approx(42.5 - 60.0)
    assert rows[JUL].customers_mom is None
    assert rows[OCT].customers_mom == 2
    narrow = {r.month: r for r in portfolio.kpi_movement(full, Filters(segments=("Mid-Market",))).collect()}
    assert narrow[AUG].vrs is None
    assert narrow[SEP].vrs_mom is None
    assert narrow[OCT].vrs_qoq == 5.0


def test_bands(full):
    mix = portfolio.band_mix(full, "2025-10-01").collect()
    assert [r.band for r in mix] == list(v.BANDS)
    assert [r.arr for r in mix] == [10.0, 100.0, 300.0, 60.0]  # unscored revenue is Critical
    kpi = one(portfolio.portfolio_kpis(full, "2025-10-01"))
    assert sum(r.arr for r in mix) == kpi["arr"]
    empty = portfolio.band_mix(full, "2030-01-01").collect()
    assert [(r.arr, r.share_pct) for r in empty] == [(0.0, None)] * 4
    history = portfolio.band_share_history(full, last=2).collect()
    assert [r.month for r in history] == [SEP, OCT]
    assert history[0].value_realized == 100.0
    change = {r.band: r for r in portfolio.band_share_change_qoq(full, "2025-10-01").collect()}
    assert change[v.AT_RISK].direction == "up"
    assert change[v.REALIZED].change_pts == pytest.approx(10 / 470 * 100 - 100 / 150 * 100, abs=1e-4)
    early = portfolio.band_share_change_qoq(full, "2025-08-01").collect()
    assert {(r.share_quarter_ago, r.direction) for r in early} == {(None, None)}


def test_trends(full):
    trend = {r.month: r.vrs for r in portfolio.portfolio_trend(full).collect()}
    assert trend[JUL] == 60.0
    risk = {r.month: r.arr_at_risk for r in portfolio.risk_trend(full).collect()}
    assert (risk[JUL], risk[AUG]) == (50.0, 0.0)
    bands = {(r.month, r.band): r.arr for r in portfolio.band_trend(full).collect()}
    assert bands[(JUL, v.CRITICAL)] == 50.0
    share = {r.month: r.at_risk_pct for r in portfolio.at_risk_share(full).collect()}
    assert share[JUL] == 33.33


def test_top_movers(full):
    rows = portfolio.top_movers(full, "2025-10-01").collect()
    # C2 and C4 had no row in September; accounts with a play come first
    assert [(r.cust_id, r.delta, r.play) for r in rows] == [
        ("C1", -39.0, "Upsell · Sales (overage 146%)"),
        ("C3", 0.0, "Win back · Account teams"),
        ("C5", -19.0, v.NO_PLAY),
    ]
    assert [r.direction for r in rows] == ["down", "flat", "down"]
    assert [r.band for r in rows] == [v.AT_RISK, v.CRITICAL, v.REALIZED]
    assert len(portfolio.top_movers(full, "2025-10-01", top=1).collect()) == 1
    assert portfolio.top_movers(full, "2025-07-01").collect() == []


def test_plays(full):
    plays = {r.cust_id: (r.play, r.owner) for r in customers.play_of_customer(full, "2025-10-01").collect()}
    assert plays == {
        "C1": ("Upsell", "Sales"),
        "C2": ("Activate", "Customer Success"),
        "C3": ("Win back", "Account teams"),
        "C4": (None, None),
        "C5": (None, None),
    }
    work = customers.play_worklist(full, "2025-10-01").collect()
    assert [(r.cust_id, r.play, r.arr_at_risk) for r in work] == [("C1", "Upsell", 300.0), ("C2", "Activate", 50.0)]
    assert [r.cust_id for r in customers.play_worklist(full, "2025-10-01", "Activate").collect()] == ["C2"]
    board = {r.play: (r.accounts, r.arr) for r in customers.play_catalog(full, "2025-10-01").collect()}
    assert board == {"Activate": (1, 50.0), "Win back": (1, 0.0), "Upsell": (1, 100.0)}
    nothing = customers.play_catalog(full, "2030-01-01").collect()
    assert [(r.accounts, r.arr) for r in nothing] == [(0, 0.0)] * 3


def test_account_summary(full):
    rows = {r.cust_id: r for r in customers.customer_summary(full, "2025-10-01").collect()}
    c1 = rows["C1"]
    assert (c1.vrs, c1.total_arr, c1.arr_at_risk) == (45.0, 400.0, 300.0)
    assert (c1.ttv_score, c1.feature_adoption) == (1.0, 0.5)  # the unknown row carries no weight
    assert rows["C3"].util_health is None  # no revenue, no weighted signal
    kpi = one(customers.customer_kpis(full, "2025-10-01"))
    assert kpi == {
        "at_risk_arr": 350.0,
        "at_risk_accounts": 2,
        "expansion_arr": 100.0,
        "expansion_accounts": 1,
        "accounts_needing_action": 2,
        "customers": 5,
    }


def test_drill_downs(full):
    mine = customers.customer_products(full, "C1", "2025-10-01").collect()
    chosen = customers.customer_products(full, "C1", "2025-10-01", Filters(platforms=("sase",))).collect()
    assert [r.product_name for r in chosen] == ["Alpha SKU-0001"] and len(mine) == 2
    assert [(r.product_name, r.platform, r.state) for r in mine] == [
        ("Beta SKU-0002", "Cloud NGFW", v.AT_RISK),
        ("Alpha SKU-0001", "SASE", v.DEVELOPING),
    ]
    assert [r.cust_name for r in customers.customer_names(full, "2025-08-01").collect()] == ["Name C1"]
    series = customers.sku_series(full, "C1", "P1").collect()
    assert [r.month for r in series] == [JUL, AUG, SEP, OCT]
    anomalies = {r.cust_id: r.anomaly for r in customers.anomaly_label(full, "2025-10-01").collect()}
    assert anomalies == {"C1": "Overage (upsell)", "C2": "Shelfware", "C3": "Spike & drop", "C4": "—", "C5": "—"}


def test_feature_detail(spark):
    rows = [("C1", "P1", f"F{i}", f"Name {i}", OCT, i, s, "x") for i, s in enumerate([0.3, 1.0, 0.0])]
    mart = spark.createDataFrame(rows, schemas.FEATURE_MONTH)
    got = customers.feature_detail(mart, "C1", "P1", "2025-10-01").collect()
    assert [r.feature_score for r in got] == [1.0, 0.3, 0.0]
    assert customers.feature_detail(mart, "C1", "P1", "2025-09-01").collect() == []


def test_products(full):
    found = products.platform_cards(full, "2025-10-01").collect()
    assert [r.product_platform for r in found] == ["sase", "cloud_ngfw"]
    cards = {r.product_platform: r for r in found}
    assert cards["cloud_ngfw"].asDict() == {
        "product_platform": "cloud_ngfw", "platform": "Cloud NGFW", "vrs": 40.0, "arr": 300.0,
        "arr_at_risk": 300.0, "at_risk_pct": 100.0,
    }
    table = products.product_model_table(full, "2025-10-01").collect()
    assert [(r.model, r.arr_at_risk, r.anomalies) for r in table] == [
        ("Beta", 300.0, "—"),
        ("Alpha", 50.0, "1 shelfware · 1 spike & drop · 1 overage"),
    ]
    assert table[0].ttv_score is None
    assert len(products.product_model_table(full, "2025-10-01", "sase").collect()) == 1
    people = products.model_customers(full, "sase", "Alpha", "2025-10-01").collect()
    assert [r.cust_id for r in people] == ["C3", "C4", "C2", "C1", "C5"]
    assert [r.anomaly for r in people][:3] == ["Spike & drop", "—", "Shelfware"]


def test_state_distribution(full):
    rows = [(r.state, r.customers) for r in portfolio.state_distribution(full).collect()]
    assert rows == [(v.REALIZED, 2), (v.CRITICAL, 1), (v.DEVELOPING, 1), (v.LAPSED, 1), (v.SHELFWARE, 1)]


def test_extensions_over_the_mart(full):
    share = {r.month: r.value_realized_pct for r in extensions.value_realized_share(full).collect()}
    assert (share[JUL], share[OCT]) == (50.0, 20.0)
    sku = full.where("product_id = 'P1'")
    moves = {(r.from_state, r.to_state): (r.direction, r.moves) for r in extensions.state_transitions(sku).where(
        F.col("month") == F.lit(OCT)).collect()}
    assert moves[(v.REALIZED, v.DEVELOPING)] == ("down", 1)
    assert moves[(v.SHELFWARE, v.SHELFWARE)] == ("same", 1)
    net = {r.month: (r.up, r.down, r.net) for r in extensions.net_transitions(sku).collect()}
    assert net[OCT] == (0, 1, -1)
    ranks = {r.cust_id: r.peer_percentile for r in extensions.peer_percentile(sku).where(
        F.col("month") == F.lit(OCT)).collect()}
    assert ranks == {"C2": 0.0, "C1": 0.333333, "C5": 0.666667, "C3": 1.0, "C4": None}


def test_categories(full):
    mart = full.withColumn("ttv_days", F.lit(45))
    got = {r.utilization_category for r in extensions.component_categories(mart).collect()}
    assert got == {"Healthy", "Overage", None}


def test_month_type(full):
    assert portfolio.portfolio_trend(full).schema["month"].dataType.simpleString() == "date"
    assert isinstance(portfolio.portfolio_trend(full).first().month, dt.date)
