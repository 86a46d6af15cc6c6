"""The checking SQL of every query in ``uptake.catalog``."""

from parity.base import (
    ANOMALY,
    EXPANSION,
    MODEL,
    MONEY,
    PLAY,
    SCORE,
    SIGNAL_NAMES,
    SIGNALS,
    WMEAN,
    advice,
    band,
    mart,
    owner,
    parameters,
    platform,
    query,
    r,
    relation,
    rs,
    total,
)
from uptake.catalog import AS_OF, CUSTOMER, LATE_VALUE, MODEL as MODEL_CHOSEN, MONTH_BEFORE as MONTH_BEFORE_DAY, OTHER, PLATFORM, PRODUCT, SOME
from uptake.params import HARSH_OVERAGE, SMOOTH_ACTIVATION
from uptake.schemas import RAW, SKU_MONTH_ASSERTED

AT = f"month = DATE '{AS_OF}'"


def _in(column: str, values: tuple[str, ...]) -> str:
    return f"{column} IN ({', '.join(repr(x) for x in values)})"


CHOSEN = " AND ".join(
    [_in("segment", SOME.segments), _in("region", SOME.regions), _in("product_platform", SOME.platforms)]
)
MONTH_BEFORE = f"(SELECT max(month) FROM m_full WHERE month < DATE '{AS_OF}')"
QUARTER_BEFORE = (
    f"(SELECT month FROM (SELECT DISTINCT month FROM m_full WHERE month < DATE '{AS_OF}') "
    "ORDER BY month DESC LIMIT 1 OFFSET 2)"
)
OWN_SUMMARY = f"""cust_id, cust_name, segment, region, {SCORE} AS vrs, {SIGNALS},
       {total()} AS total_arr, {total("vrs < 50")} AS arr_at_risk"""

# ---- helper relations -----------------------------------------------------

relation("m_now", f"SELECT * FROM m_full WHERE {AT}")
relation("m_some", f"SELECT * FROM m_full WHERE {CHOSEN}")


def kpi_sql(rows: str, middle: str = "50") -> str:
    return f"""SELECT month, {SCORE} AS vrs, {total()} AS arr, {total(f"vrs < {middle}")} AS at_risk_arr,
       (SELECT count(*) FROM (SELECT cust_id FROM {rows} i WHERE i.month = o.month
          GROUP BY cust_id HAVING {SCORE} < 50)) AS customers_at_risk,
       count(*) FILTER (vrs < {middle}) AS skus_at_risk, count(DISTINCT cust_id) AS customers,
       {total("flag_expansion")} AS expansion_arr,
       count(DISTINCT cust_id) FILTER (flag_expansion) AS expansion_customers
FROM {rows} o GROUP BY month"""


relation("m_kpi", kpi_sql("m_full"))
relation(
    "m_band",
    f"""SELECT month, {total("vrs >= 70")} AS value_realized, {total("vrs >= 50 AND vrs < 70")} AS developing,
       {total("vrs >= 30 AND vrs < 50")} AS at_risk, {total("coalesce(vrs < 30, true)")} AS critical
FROM m_full GROUP BY month""",
)
BANDS = ("value_realized", "developing", "at_risk", "critical")
_ALL = "(" + " + ".join(BANDS) + ")"
relation("m_share", f"SELECT month, {', '.join(f'{b} / nullif({_ALL}, 0) * 1e2 AS {b}' for b in BANDS)} FROM m_band")
relation(
    "m_silent",
    "SELECT cust_id FROM src_consumption GROUP BY cust_id HAVING sum(consumed_units) = 0",
)
relation("m_heavy", "SELECT cust_id FROM m_sku GROUP BY cust_id HAVING avg(lur) > 1.2e0")
relation(
    "m_volume",
    """SELECT feature_id, median(usage_events)::DOUBLE AS expected_active_volume, count(*) AS active_user_months
FROM src_feature_adoption WHERE usage_events > 0 GROUP BY feature_id""",
)

# score parameters by segment and platform, as CASE expressions
_BIG_SASE = "segment = 'Enterprise' AND product_platform = 'sase'"
OVERRIDDEN = parameters(
    weight_utilization=f"(CASE WHEN {_BIG_SASE} THEN 0.45e0 WHEN segment = 'Enterprise' THEN 0.3e0 ELSE 0.35e0 END)",
    weight_speed=f"(CASE WHEN {_BIG_SASE} THEN 0.05e0 ELSE 0.15e0 END)",
    weight_features="(CASE WHEN segment = 'Enterprise' THEN 0.3e0 ELSE 0.25e0 END)",
    overage_score="(CASE WHEN product_platform = 'hardware_ngfw' THEN 0.6e0 ELSE 0.8e0 END)",
)
relation(
    "m_sku_attributes",
    """SELECT m.*, segment, product_platform FROM m_sku m
JOIN (SELECT cust_id, segment FROM src_customers) USING (cust_id)
JOIN (SELECT product_id, product_platform FROM src_products) USING (product_id)""",
)
relation(
    "m_first_signal",
    """SELECT cust_id, product_id, min(month) AS first_value_month FROM (
  SELECT cust_id, product_id, month FROM m_sku WHERE lur >= 0.1e0
  UNION ALL SELECT cust_id, product_id, month FROM src_feature_adoption WHERE usage_events > 0) GROUP BY ALL""",
)

# ---- assertions -----------------------------------------------------------

_TYPE_NAMES = {"string": "VARCHAR", "bigint": "BIGINT", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN"}


def _typed(table: str, schema) -> str:
    tests = " + ".join(
        f"(typeof({f.name}) = '{_TYPE_NAMES[f.dataType.simpleString()]}')::INT" for f in schema.fields
    )
    return f"(SELECT max({tests}) FROM {table})"


_PARTIAL = "ttv_score > 0 AND ttv_score < 1"
_RISKY = "state IN ('Churn Signal', 'Shelfware Risk', 'Lapsed', 'Onboarding Stall') OR flag_expansion"
_ORPHANS = "(SELECT count(*) FROM {facts} x WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = x.{key}))"
DQ = [
    ("integrity", "orphan_consumption_customers", 0, _ORPHANS.format(facts="src_consumption", dim="src_customers", key="cust_id")),
    ("integrity", "orphan_consumption_products", 0, _ORPHANS.format(facts="src_consumption", dim="src_products", key="product_id")),
    ("integrity", "orphan_consumption_entitlements", 0, _ORPHANS.format(facts="src_consumption", dim="src_entitlements", key="entitlement_id")),
    ("integrity", "orphan_feature_adoption_features", 0, _ORPHANS.format(facts="src_feature_adoption", dim="src_features", key="feature_id")),
    ("integrity", "sku_month_grain_unique", 0, "(SELECT count(*) - count(DISTINCT (cust_id, product_id, month)) FROM m_mart)"),
    ("integrity", "vrs_within_0_100", 0, "(SELECT count(*) FROM m_mart WHERE vrs < 0 OR vrs > 100)"),
    ("integrity", "components_within_0_1", 0, "(SELECT count(*) FROM m_mart WHERE " + " OR ".join(f"{c} < 0 OR {c} > 1" for c in SIGNAL_NAMES) + ")"),
    ("integrity", "no_negative_or_zero_license", 0, "(SELECT count(*) FROM src_consumption WHERE consumed_units < 0 OR licensed_amount <= 0)"),
    ("integrity", "twelve_months_present", 12, "(SELECT count(DISTINCT month) FROM src_consumption)"),
    ("integrity", "every_entitlement_has_consumption", 0, _ORPHANS.format(facts="src_entitlements", dim="src_consumption", key="entitlement_id")),
    ("overlap", "overlap_pairs_exist_ge6", 6, """(SELECT least(count(*), 6) FROM src_entitlements a JOIN src_entitlements b USING (cust_id, product_id)
       WHERE a.entitlement_id < b.entitlement_id
       AND greatest(a.start_date, b.start_date) < least(a.end_date, b.end_date))"""),
    ("overlap", "licensed_equals_sum_active_entitlements", 0, """(SELECT count(*) FROM m_sku JOIN
       (SELECT cust_id, product_id, month, sum(units) AS lic FROM star_spine GROUP BY ALL) USING (cust_id, product_id, month)
       WHERE abs(licensed_amount - lic) > 0.5)"""),
    ("anomaly", "shelfware_accounts_eq_10", 10, "(SELECT count(*) FROM m_silent)"),
    ("anomaly", "shelfware_all_state_shelfware_risk", 0, "(SELECT count(*) FROM m_mart SEMI JOIN m_silent USING (cust_id) WHERE state NOT IN ('Shelfware Risk', 'Grace Period'))"),
    ("anomaly", "overage_accounts_eq_15", 15, "(SELECT count(*) FROM m_heavy)"),
    ("anomaly", "overage_all_raise_expansion_flag", 0, "(SELECT count(*) FROM m_heavy ANTI JOIN (SELECT cust_id FROM m_mart WHERE flag_expansion) USING (cust_id))"),
    ("anomaly", "churn_signal_customers_eq_5", 5, "(SELECT count(DISTINCT cust_id) FROM m_mart WHERE state = 'Churn Signal')"),
    ("anomaly", "slow_onboarder_accounts_eq_5", 5, "(SELECT count(*) FROM src_customers WHERE behavior_profile = 'slow_onboarder')"),
    ("anomaly", "slow_onboarders_all_hit_onboarding_stall", 0, """(SELECT count(*) FROM src_customers ANTI JOIN
       (SELECT cust_id FROM m_mart WHERE state = 'Onboarding Stall') USING (cust_id) WHERE behavior_profile = 'slow_onboarder')"""),
    ("anomaly", "partial_ttv_band_exercised", 1, f"(SELECT count(*) > 0 FROM m_mart WHERE {_PARTIAL})"),
    ("ground_truth", "normal_no_risk_states_or_expansion", 0, f"(SELECT count(*) FROM m_full JOIN (SELECT cust_id FROM src_customers WHERE behavior_profile = 'normal') USING (cust_id) WHERE {_RISKY})"),
    *[("schema", f"{name}_schema", len(s), _typed(f"src_{name}", s)) for name, s in RAW.items()],
    ("schema", "mart_sku_month_schema", 13, _typed("m_mart", SKU_MONTH_ASSERTED)),
    ("unit", "shelfware_scores_zero", 0, "(SELECT count(*) FROM m_mart WHERE lur < 0.1e0 AND util_health <> 0)"),
    ("unit", "overage_capped_and_flagged", 0, "(SELECT count(*) FROM m_mart WHERE lur > 1.2e0 AND (util_health <> 0.8e0 OR NOT flag_expansion))"),
    ("unit", "peak_band_scores_one", 0, "(SELECT count(*) FROM m_mart WHERE lur BETWEEN 1e0 AND 1.2e0 AND util_health <> 1)"),
    ("unit", "partial_ttv_implies_31_90_days", 0, f"(SELECT count(*) FROM m_mart WHERE {_PARTIAL} AND NOT ttv_days BETWEEN 31 AND 90)"),
    ("regression", "total_rows_stable", 5483, "(SELECT count(*) FROM m_mart)"),
    ("regression", "vrs_checksum_stable", 0, "(SELECT NOT coalesce(abs(sum(vrs) - 373804) < 2, false) FROM m_mart)"),
    ("regression", "latest_month_arr_stable", 0, f"(SELECT NOT coalesce(abs(sum(arr) - 146499822) < 5, false) FROM m_mart WHERE {AT})"),
    ("freshness", "latest_month_is_current", 0, f"(SELECT NOT coalesce(max(month) = DATE '{AS_OF}', false) FROM m_mart)"),
]
DQ_SQL = "SELECT *, CASE WHEN val = expect THEN 'PASS' ELSE 'FAIL' END AS result FROM (" + "\nUNION ALL ".join(
    f"SELECT '{cat}' AS cat, '{test}' AS test, coalesce({sql}::BIGINT, 0) AS val, {expect}::BIGINT AS expect"
    for cat, test, expect, sql in DQ
) + ")"

relation(
    "m_first_late",
    f"SELECT cust_id, product_id, min(month) AS first_value_month FROM m_sku WHERE lur >= {LATE_VALUE.use_floor}e0 GROUP BY ALL",
)

# ---- carried state --------------------------------------------------------


def state_sql(through: str) -> str:
    """The last rows of every SKU by number, found by self joins."""
    return f"""SELECT * FROM (WITH past AS (SELECT *, row_number() OVER (PARTITION BY cust_id, product_id ORDER BY month DESC) AS n,
       (lur >= 0.1e0)::INTEGER AS active FROM m_sku WHERE month <= {through})
SELECT a.cust_id, a.product_id, a.lur AS lur1, b.lur AS lur2, c.lur AS lur3, a.active AS active1, b.active AS active2,
       (SELECT max(active) FROM past x WHERE x.cust_id = a.cust_id AND x.product_id = a.product_id) AS ever_active,
       (SELECT min(month) FROM past x WHERE x.cust_id = a.cust_id AND x.product_id = a.product_id AND active = 1) AS first_value_month
FROM past a LEFT JOIN past b ON b.cust_id = a.cust_id AND b.product_id = a.product_id AND b.n = 2
LEFT JOIN past c ON c.cust_id = a.cust_id AND c.product_id = a.product_id AND c.n = 3 WHERE a.n = 1)"""


# ---- the register ---------------------------------------------------------

RULED = {
    "weight_utilization": f"(CASE WHEN {_BIG_SASE} THEN 0.45e0 WHEN segment = 'Enterprise' THEN 0.3e0 ELSE 0.35e0 END)",
    "weight_features": "(CASE WHEN segment = 'Enterprise' THEN 0.3e0 ELSE 0.25e0 END)",
    "overage_score": "(CASE WHEN product_platform <> 'hardware_ngfw' THEN 0.8e0 WHEN month < DATE '2026-01-01' THEN 0.6e0 ELSE 0.5e0 END)",
    "feature_idle": "(CASE WHEN product_platform = 'sase' AND month >= DATE '2026-01-01' AND month < DATE '2026-05-01' THEN 0.2e0 ELSE 0.3e0 END)",
    "band_middle": "(CASE WHEN segment = 'Enterprise' THEN 55e0 WHEN month >= DATE '2026-06-01' THEN 45e0 ELSE 50e0 END)",
}
relation(
    "r_feature",
    f"""SELECT f.* EXCLUDE (feature_score), feature_score AS plain,
       CASE WHEN feature_score = 0.3e0 THEN {RULED["feature_idle"]} ELSE feature_score END AS feature_score
FROM m_feature f JOIN (SELECT cust_id, segment FROM src_customers) USING (cust_id)
JOIN (SELECT product_id, product_platform FROM src_products) USING (product_id)""",
)
relation(
    "r_breadth",
    """SELECT cust_id, product_id, month, sum(round(feature_score * 1000)::BIGINT)::DOUBLE / (1000e0 * count(*)) AS feature_adoption
FROM r_feature GROUP BY ALL""",
)
relation("r_mart", mart(parameters(**RULED), source="m_sku_attributes", breadth="r_breadth"))
relation(
    "r_full",
    f"""SELECT *, {RULED["band_middle"]} AS middle, {RULED["overage_score"]} AS ceiling FROM (
  SELECT m.* EXCLUDE (ttv_days), cust_name, segment, region, product_name, product_platform
  FROM r_mart m JOIN src_customers USING (cust_id) JOIN src_products USING (product_id))""",
)
relation("c_mart", mart(parameters(HARSH_OVERAGE)))
relation("c_full", "SELECT m.*, 0.6e0 AS ceiling FROM c_mart m")


def dq_of(mart_name: str, full_name: str) -> str:
    """The assertions over another mart, with its rows' own overage score."""
    over = f"(SELECT count(*) FROM {full_name} WHERE lur > 1.2e0 AND (util_health <> ceiling OR NOT flag_expansion))"
    parts = []
    for cat, test, expect, sql in DQ:
        sql = over if test == "overage_capped_and_flagged" else sql.replace("m_mart", mart_name).replace("m_full", full_name)
        parts.append(f"SELECT '{cat}' AS cat, '{test}' AS test, coalesce({sql}::BIGINT, 0) AS val, {expect}::BIGINT AS expect")
    return "SELECT *, CASE WHEN val = expect THEN 'PASS' ELSE 'FAIL' END AS result FROM (" + "\nUNION ALL ".join(parts) + ")"


# ---- one SELECT per query -------------------------------------------------

_COMPONENT_SQL = ", ".join(
    f"{r(c, 6)} AS {c}" for c in ("lur", "util_health", "feature_adoption", "sustained_usage", "prior_lur")
)
_MOVE_RANK = """CASE {s} WHEN 'Churn Signal' THEN 1 WHEN 'Lapsed' THEN 2 WHEN 'Shelfware Risk' THEN 3
  WHEN 'Onboarding Stall' THEN 4 WHEN 'Critical' THEN 5 WHEN 'At Risk' THEN 6 WHEN 'Grace Period' THEN 7
  WHEN 'Developing' THEN 8 ELSE 9 END"""
relation(
    "m_moves",
    f"""SELECT month, was AS from_state, state AS to_state,
       sign({_MOVE_RANK.format(s="state")} - {_MOVE_RANK.format(s="was")})::INTEGER AS step
FROM (SELECT *, lag(state) OVER (PARTITION BY cust_id, product_id ORDER BY month) AS was FROM m_mart)
WHERE was IS NOT NULL""",
)
relation(
    "m_movers",
    f"""SELECT *, {rs("vrs - vrs_prev", 1)} AS delta FROM (
  SELECT cust_id, max(cust_name) AS cust_name, {SCORE} AS vrs, {total()} AS arr, {PLAY} AS name,
         max(lur) FILTER (flag_expansion) AS overage FROM m_now GROUP BY cust_id)
JOIN (SELECT cust_id, {SCORE} AS vrs_prev FROM m_full WHERE month = {MONTH_BEFORE} GROUP BY cust_id) USING (cust_id)""",
)


def _changes() -> str:
    parts = []
    for name in ("vrs", "arr", "at_risk_arr", "customers_at_risk", "skus_at_risk", "customers", "expansion_arr", "expansion_customers"):
        for tag, steps in (("mom", 1), ("qoq", 3)):
            change = f"{name} - lag({name}, {steps}) OVER (ORDER BY month)"
            parts.append(f"{rs(change, 2) if name == 'vrs' or name.endswith('arr') else change} AS {name}_{tag}")
    return ", ".join(parts)


_QOQ = "\nUNION ALL ".join(
    f"""SELECT '{label}' AS band, {r(f"a.{c}", 4)} AS share_now, {r(f"b.{c}", 4)} AS share_quarter_ago,
       {rs(f"a.{c} - b.{c}", 4)} AS change_pts
FROM (SELECT * FROM m_share WHERE {AT}) a, (SELECT * FROM m_share WHERE month = {QUARTER_BEFORE}) b"""
    for label, c in zip(("Value Realized", "Developing", "At Risk", "Critical"), BANDS, strict=True)
)
_MIX = "\nUNION ALL ".join(
    f"SELECT {i + 1}::INTEGER AS position, '{label}' AS band, {c} AS arr, {r(f'{c} / nullif({_ALL}, 0) * 1e2', 2)} AS share_pct "
    f"FROM m_band WHERE {AT}"
    for i, (label, c) in enumerate(zip(("Value Realized", "Developing", "At Risk", "Critical"), BANDS, strict=True))
)
relation(
    "r_band",
    f"""SELECT month, {total("vrs >= 70")} AS value_realized, {total("vrs >= middle AND vrs < 70")} AS developing,
       {total("vrs >= 30 AND vrs < middle")} AS at_risk, {total("coalesce(vrs < 30, true)")} AS critical
FROM r_full GROUP BY month""",
)
_MIX_RULED = _MIX.replace("m_band", "r_band")
_CATALOG = "\nUNION ALL ".join(
    f"""SELECT '{play}' AS play, '{who}' AS owner, '{kind}' AS trigger_type, '{trigger}' AS trigger,
       '{side}' AS kind, '{addresses}' AS addresses,
       count(DISTINCT cust_id) FILTER ({test}) AS accounts, {total(test)} AS arr FROM m_now"""
    for play, who, kind, trigger, side, addresses, test in (
        ("Activate", "Customer Success", "state", "Shelfware Risk", "at risk", "Shelfware", "state = 'Shelfware Risk'"),
        ("Win back", "Account teams", "state", "Churn Signal, Lapsed", "at risk", "Spike & drop", "state IN ('Churn Signal', 'Lapsed')"),
        ("Upsell", "Sales", "flag", "flag_expansion", "upside", "Consistent overage", "flag_expansion"),
    )
)
_WORKLIST = f"""SELECT cust_id, cust_name, segment, play, {owner("play")} AS owner, vrs, {", ".join(SIGNAL_NAMES)},
       total_arr, arr_at_risk
FROM (SELECT {OWN_SUMMARY}, {PLAY} AS play FROM m_now GROUP BY cust_id, cust_name, segment, region
      HAVING bool_or(vrs < 50) OR {EXPANSION}) WHERE play IS NOT NULL"""
_SNAPSHOT = """SELECT cust_id, cust_name, segment, region, product_id, product_name, product_platform, vrs, arr, lur,
       util_health, feature_adoption, sustained_usage, ttv_score, state, flag_expansion, flag_single_feature_dependency"""
_ROLL = f"""{r(WMEAN, 1)} AS vrs_arr_weighted, {r(f"sum({MONEY})::DOUBLE", 0)} AS total_arr,
       {r(total("vrs < 50"), 0)} AS arr_at_risk"""
_ANOMALY_TEXT = """CASE WHEN shelfware_accounts + drop_accounts + overage_accounts = 0 THEN '—' ELSE concat_ws(' · ',
         CASE WHEN shelfware_accounts > 0 THEN shelfware_accounts || ' shelfware' END,
         CASE WHEN drop_accounts > 0 THEN drop_accounts || ' spike & drop' END,
         CASE WHEN overage_accounts > 0 THEN overage_accounts || ' overage' END) END"""
_MD5 = "('0x' || substr(md5({k}), 1, 8))::BIGINT"

_CHANGED = f"""SELECT cust_id, product_id, month, 1::BIGINT AS left_n, CASE WHEN cust_id = '{CUSTOMER}' THEN 1::BIGINT END AS right_n,
       CASE WHEN cust_id = '{CUSTOMER}' THEN 'differs' ELSE 'left only' END AS kind
FROM m_full WHERE cust_id = '{CUSTOMER}' AND {AT} AND vrs IS NOT NULL OR cust_id = '{OTHER}' AND month = DATE '{MONTH_BEFORE_DAY}'"""

SELECTS = {
    "stg_sku_month": "SELECT * FROM m_sku",
    "stg_feature_month": "SELECT * FROM m_feature",
    "feature_adoption_avg": "SELECT * FROM m_breadth",
    "int_sku_components": f"""SELECT cust_id, product_id, month, consumed_units, licensed_amount, {_COMPONENT_SQL},
       ever_active_before FROM m_components""",
    "ent_start": "SELECT * FROM m_start",
    "first_value_month": "SELECT * FROM m_first",
    "ttv": """SELECT cust_id, product_id, arr, start_date, days::INTEGER AS ttv_days,
       CASE WHEN days <= 30 THEN 1e0 WHEN days <= 90 THEN 1e0 - (days - 30e0) / 60e0 ELSE 0e0 END AS ttv_score
FROM (SELECT *, first_value_month - start_date AS days FROM m_start LEFT JOIN m_first USING (cust_id, product_id))""",
    "mart_customer_sku_month": "SELECT * FROM m_mart",
    "mart_customer_feature_month": """SELECT cust_id, product_id, feature_id, feature_name, month, usage_events, feature_score,
       CASE feature_score WHEN 0e0 THEN 'not_enabled' WHEN 0.3e0 THEN 'enabled_idle' WHEN 0.7e0 THEN 'active'
            ELSE 'deep' END AS adoption_level FROM m_feature""",
    "mart_customer_month": f"""SELECT cust_id, cust_name, segment, region, month, {_ROLL},
       {r("sum(vrs::DECIMAL(5,1))::DOUBLE / count(vrs)", 1)} AS vrs_simple_avg, count(*) AS skus
FROM m_mart JOIN src_customers USING (cust_id) GROUP BY cust_id, cust_name, segment, region, month""",
    "mart_product_month": f"""SELECT product_id, product_name, product_platform, month, {_ROLL},
       count(DISTINCT cust_id) AS customers
FROM m_mart JOIN src_products USING (product_id) GROUP BY product_id, product_name, product_platform, month""",
    "sku_state": state_sql("DATE '2026-05-01'"),
    "sku_state_advanced": state_sql("DATE '2026-06-01'"),
    "mart_month_append": "SELECT * FROM m_mart WHERE month = DATE '2026-06-01'",
    "mart_month_restated": f"""SELECT m.* FROM ({mart(parameters(LATE_VALUE), first="m_first_late")}) m
JOIN m_first_late f USING (cust_id, product_id) WHERE f.first_value_month = DATE '2026-06-01' AND m.month < DATE '2026-06-01'""",
    "mart_sku_month_full": "SELECT * FROM m_full",
    "mart_feature_full": """SELECT cust_id, product_id, feature_name, month, usage_events, feature_score,
       CASE WHEN feature_score = 0 THEN 'not_enabled' WHEN feature_score < 0.5e0 THEN 'enabled_idle'
            WHEN feature_score < 1 THEN 'active' ELSE 'deep' END AS adoption_level FROM m_feature""",
    "months": "SELECT DISTINCT strftime(month, '%Y-%m') AS month FROM m_full ORDER BY 1",
    "latest_month": "SELECT max(month) AS month FROM m_full",
    "snapshot": f"{_SNAPSHOT} FROM m_now",
    "snapshot_filtered": f"{_SNAPSHOT} FROM m_some WHERE {AT}",
    "portfolio_trend": f"SELECT month, {r(WMEAN, 6)} AS vrs FROM m_full GROUP BY month ORDER BY month",
    "portfolio_trend_filtered": f"SELECT month, {r(WMEAN, 6)} AS vrs FROM m_some GROUP BY month ORDER BY month",
    "risk_trend": f"SELECT month, {total('vrs < 50')} AS arr_at_risk FROM m_full GROUP BY month ORDER BY month",
    "band_trend": f"SELECT month, {band('vrs')} AS band, {total()} AS arr FROM m_full GROUP BY ALL ORDER BY 1, 2",
    "portfolio_kpis": f"SELECT * EXCLUDE (month) FROM m_kpi WHERE {AT}",
    "portfolio_kpis_filtered": f"SELECT * EXCLUDE (month) FROM ({kpi_sql('m_some')}) WHERE {AT}",
    "kpi_movement": f"SELECT *, {_changes()} FROM m_kpi ORDER BY month",
    "band_mix": _MIX,
    "band_share_history": f"""SELECT month, {", ".join(f"{r(b, 4)} AS {b}" for b in BANDS)}
FROM (SELECT * FROM m_share ORDER BY month DESC LIMIT 12) ORDER BY month""",
    "band_share_change_qoq": f"""SELECT *, CASE WHEN abs(change_pts) < 0.05e0 THEN 'flat' WHEN change_pts > 0 THEN 'up'
       WHEN change_pts < 0 THEN 'down' END AS direction FROM ({_QOQ})""",
    "top_movers": f"""SELECT cust_id, cust_name, vrs, vrs_prev, delta,
       CASE WHEN delta > 0 THEN 'up' WHEN delta < 0 THEN 'down' ELSE 'flat' END AS direction, arr,
       {band("vrs")} AS band, {advice("name", "overage")} AS play
FROM m_movers ORDER BY (name IS NOT NULL) DESC, abs(delta) DESC, cust_id LIMIT 7""",
    "state_distribution": "SELECT state, count(DISTINCT cust_id) AS customers FROM m_full GROUP BY state ORDER BY 2 DESC, 1",
    "play_of_customer": f"""SELECT cust_id, play, {owner("play")} AS owner, max_overage_lur,
       {advice("play", "max_overage_lur")} AS advice
FROM (SELECT cust_id, {PLAY} AS play, max(lur) FILTER (flag_expansion) AS max_overage_lur FROM m_now GROUP BY cust_id)""",
    "play_catalog": _CATALOG,
    "customer_summary": f"SELECT {OWN_SUMMARY} FROM m_now GROUP BY cust_id, cust_name, segment, region",
    "customer_kpis": f"""SELECT {total("vrs < 50")} AS at_risk_arr,
       count(DISTINCT cust_id) FILTER (vrs < 50) AS at_risk_accounts, {total("flag_expansion")} AS expansion_arr,
       count(DISTINCT cust_id) FILTER (flag_expansion) AS expansion_accounts,
       count(DISTINCT cust_id) FILTER (vrs < 50 OR flag_expansion) AS accounts_needing_action,
       count(DISTINCT cust_id) AS customers FROM m_now""",
    "play_worklist": f"{_WORKLIST} ORDER BY arr_at_risk DESC, total_arr DESC, cust_id",
    "play_worklist_activate": f"{_WORKLIST} AND play = 'Activate' ORDER BY arr_at_risk DESC, total_arr DESC, cust_id",
    "customer_products": f"""SELECT product_name, {platform("product_platform")} AS platform, vrs, {band("vrs")} AS state,
       {", ".join(SIGNAL_NAMES)}, arr FROM m_now WHERE cust_id = '{CUSTOMER}' ORDER BY vrs, product_name""",
    "customer_products_filtered": f"""SELECT product_name, {platform("product_platform")} AS platform, vrs, {band("vrs")} AS state,
       {", ".join(SIGNAL_NAMES)}, arr FROM m_now
WHERE cust_id = '{CUSTOMER}' AND product_platform IN ('hardware_ngfw', 'sase') ORDER BY vrs, product_name""",
    "entitlements_csv_roundtrip": """SELECT entitlement_id, product_id, cust_id, units_purchased, licensed_amount,
       unit_price, arr, start_date, end_date, is_expansion FROM src_entitlements""",
    "sku_full_csv_roundtrip": "SELECT * FROM m_full",
    "raw_csv_roundtrip": "\nUNION ALL ".join(
        f"""SELECT '{name}' AS table_name, count(*) AS rows, sum({_MD5.format(k=schema.names[0])})::BIGINT AS key_sum FROM src_{name}"""
        for name, schema in RAW.items()
    ),
    "catalog_table_roundtrip": "SELECT * FROM m_mart",
    "persisted_sku_view": "SELECT * FROM m_sku",
    "persisted_feature_view": "SELECT * FROM m_feature",
    "dq_gate": f"""SELECT count(*) FILTER (result = 'PASS') AS passed, count(*) FILTER (result <> 'PASS') AS failed,
       coalesce(string_agg(test, ', ' ORDER BY test) FILTER (result <> 'PASS'), '') AS failed_tests,
       CASE WHEN count(*) FILTER (result <> 'PASS') = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict
FROM ({DQ_SQL})""",
    "feature_full_csv_roundtrip": """SELECT cust_id, product_id, feature_name, month, usage_events, feature_score,
       CASE WHEN feature_score = 0 THEN 'not_enabled' WHEN feature_score < 0.5e0 THEN 'enabled_idle'
            WHEN feature_score < 1 THEN 'active' ELSE 'deep' END AS adoption_level FROM m_feature""",
    "customer_names": "SELECT DISTINCT cust_name FROM m_now ORDER BY 1",
    "feature_detail": f"""SELECT feature_name, usage_events, feature_score,
       CASE WHEN feature_score = 0 THEN 'not_enabled' WHEN feature_score < 0.5e0 THEN 'enabled_idle'
            WHEN feature_score < 1 THEN 'active' ELSE 'deep' END AS adoption_level
FROM m_feature WHERE cust_id = '{CUSTOMER}' AND product_id = '{PRODUCT}' AND {AT} ORDER BY feature_score DESC, feature_name""",
    "sku_series": f"""SELECT month, lur, vrs, state FROM m_mart
WHERE cust_id = '{CUSTOMER}' AND product_id = '{PRODUCT}' ORDER BY month""",
    "anomaly_label": f"SELECT cust_id, {ANOMALY} AS anomaly FROM m_now GROUP BY cust_id",
    "platform_cards": f"""SELECT product_platform, {platform("product_platform")} AS platform, vrs, arr, arr_at_risk,
       {r("coalesce(arr_at_risk / nullif(arr, 0) * 1e2, 0e0)", 2)} AS at_risk_pct
FROM (SELECT product_platform, {SCORE} AS vrs, {total("vrs < 50")} AS arr_at_risk, {total()} AS arr
      FROM m_now GROUP BY product_platform)""",
    "product_model_table": f"""SELECT product_platform, {platform("product_platform")} AS platform, model, vrs,
       {", ".join(SIGNAL_NAMES)}, revenue AS arr, arr_at_risk, shelfware_accounts, drop_accounts, overage_accounts,
       {_ANOMALY_TEXT} AS anomalies
FROM (SELECT product_platform, {MODEL} AS model, {SCORE} AS vrs, {SIGNALS}, {total()} AS revenue,
        {total("vrs < 50")} AS arr_at_risk,
        count(DISTINCT cust_id) FILTER (state = 'Shelfware Risk') AS shelfware_accounts,
        count(DISTINCT cust_id) FILTER (state IN ('Churn Signal', 'Lapsed')) AS drop_accounts,
        count(DISTINCT cust_id) FILTER (flag_expansion) AS overage_accounts
      FROM m_now GROUP BY ALL) ORDER BY arr_at_risk DESC, product_platform, model""",
    "model_customers": f"""SELECT cust_id, cust_name, segment, region, {ANOMALY} AS anomaly, {SCORE} AS vrs, {SIGNALS},
       {total()} AS arr FROM m_now WHERE product_platform = '{PLATFORM}' AND {MODEL} = '{MODEL_CHOSEN}'
GROUP BY cust_id, cust_name, segment, region ORDER BY 6, 1""",
    "dq_report": DQ_SQL,
    "build_parity": """SELECT unnest(['row count', 'score checksum', 'revenue checksum']) AS check,
       unnest([n, v, a]) AS left_value, unnest([0e0, 2e0, 5e0]) AS tolerance, unnest([n, v, a]) AS right_value,
       'OK' AS verdict
FROM (SELECT count(*)::DOUBLE AS n, sum(vrs::DECIMAL(5,1))::DOUBLE AS v, sum(arr::DECIMAL(18,2))::DOUBLE AS a FROM m_mart)""",
    "export_parity": """SELECT count(*) AS left_rows, count(*) AS right_rows, 0::BIGINT AS keys, 0::BIGINT AS customers,
       'OK' AS verdict FROM m_full""",
    "changed_export_parity": f"""SELECT (SELECT count(*) FROM m_full) AS left_rows,
       (SELECT count(*) FROM m_full) - count(*) FILTER (kind = 'left only') AS right_rows, count(*) AS keys,
       count(DISTINCT cust_id) AS customers, 'WARNING' AS verdict FROM ({_CHANGED})""",
    "changed_export_keys": _CHANGED,
    "source_profile": "\nUNION ALL ".join(
        [f"SELECT 'rows {name}' AS metric, count(*) AS value FROM src_{name}" for name in RAW]
        + [
            "SELECT 'label ' || behavior_profile, count(*) FROM src_customers GROUP BY behavior_profile",
            "SELECT 'accounts without use', count(*) FROM m_silent",
            """SELECT 'accounts above 1.2 on average', count(*) FROM (SELECT cust_id FROM src_consumption GROUP BY cust_id
               HAVING avg(consumed_units / licensed_amount) > 1.2e0)""",
            """SELECT 'overlapping contract pairs', count(*) FROM src_entitlements a JOIN src_entitlements b
               USING (cust_id, product_id) WHERE a.entitlement_id < b.entitlement_id
               AND greatest(a.start_date, b.start_date) < least(a.end_date, b.end_date)""",
        ]
    ),
    "overlap_pairs": """SELECT a.cust_id, a.product_id, count(*) FILTER (a.entitlement_id < b.entitlement_id
       AND greatest(a.start_date, b.start_date) < least(a.end_date, b.end_date)) AS pairs
FROM src_entitlements a JOIN src_entitlements b USING (cust_id, product_id) GROUP BY ALL""",
    "source_reconciliation": """SELECT 'units' AS measure, sum(l_quantity::DECIMAL(12,2))::DOUBLE AS given,
       (SELECT sum(consumed_units::DECIMAL(18,2))::DOUBLE FROM src_consumption) AS derived FROM lineitem
UNION ALL SELECT 'events', count(*)::DOUBLE, (SELECT sum(usage_events)::DOUBLE FROM src_feature_adoption) FROM lineitem""",
    "month_spine": "SELECT entitlement_id, month, idx::INTEGER AS month_idx FROM star_spine",
    "hash_bucket": f"""SELECT entitlement_id, ({_MD5.format(k="'bucket-' || entitlement_id")} % 16)::INTEGER AS bucket
FROM src_entitlements""",
    "quota_cohort": f"""SELECT cust_id, CASE WHEN n <= 3 THEN 'pilot' WHEN n <= 7 THEN 'control' ELSE 'everyone else' END AS cohort
FROM (SELECT cust_id, row_number() OVER (ORDER BY {_MD5.format(k="'cohort-' || cust_id")}, cust_id) AS n FROM src_customers)""",
    "surrogate_key": """SELECT entitlement_id, cust_id, product_id, is_expansion,
       printf('E%05d', row_number() OVER (ORDER BY cust_id, is_expansion, product_id)) AS contract_no FROM src_entitlements""",
    "feature_thresholds": f"""SELECT feature_id, {r("0.2e0 * expected_active_volume", 0)}::BIGINT AS meaningful_floor_events,
       {r("0.8e0 * expected_active_volume", 0)}::BIGINT AS deep_threshold_events FROM m_volume""",
    "contract_union": """SELECT entitlement_id, product_id, cust_id, units_purchased, licensed_amount, unit_price, start_date,
       is_expansion FROM src_entitlements""",
    "contract_terms": "SELECT entitlement_id, arr, end_date FROM src_entitlements",
    "active_length": """SELECT entitlement_id, feature_id, month, count(*) OVER (PARTITION BY entitlement_id, feature_id) AS active_len
FROM star_spine JOIN (SELECT product_id, feature_id FROM src_features) USING (product_id)""",
    "contract_features": "SELECT entitlement_id, product_id, feature_id FROM src_entitlements JOIN src_features USING (product_id)",
    "expected_volume": "SELECT * FROM m_volume",
    "value_realized_share": f"""SELECT month, count(*) AS accounts, count(*) FILTER (score >= 70) AS value_realized_accounts,
       {r("count(*) FILTER (score >= 70)::DOUBLE / count(*) * 1e2", 2)} AS value_realized_pct
FROM (SELECT month, cust_id, {SCORE} AS score FROM m_mart GROUP BY ALL) GROUP BY month""",
    "state_transitions": """SELECT month, from_state, to_state,
       CASE WHEN step > 0 THEN 'up' WHEN step < 0 THEN 'down' ELSE 'same' END AS direction, count(*) AS moves
FROM m_moves GROUP BY ALL""",
    "net_transitions": """SELECT month, count(*) FILTER (step > 0) AS up, count(*) FILTER (step < 0) AS down,
       sum(step)::BIGINT AS net FROM m_moves GROUP BY month""",
    "first_adopted": f"""SELECT cust_id, product_id, feature_id, min(month) FILTER (events > 0) AS first_adopted_month,
       count(*) FILTER (events > 0) AS active_months, max(events) AS peak_events,
       {r("max(events)::DOUBLE / max(deep_threshold_events)", 4)} AS peak_intensity
FROM (SELECT cust_id, product_id, feature_id, month, sum(usage_events)::BIGINT AS events FROM src_feature_adoption GROUP BY ALL)
JOIN (SELECT feature_id, deep_threshold_events FROM src_features) USING (feature_id) GROUP BY ALL""",
    "feature_shelfware": """SELECT DISTINCT e.cust_id, e.product_id, f.feature_id
FROM src_entitlements e JOIN src_features f USING (product_id)
WHERE NOT EXISTS (SELECT 1 FROM src_feature_adoption a WHERE a.cust_id = e.cust_id AND a.product_id = e.product_id
                  AND a.feature_id = f.feature_id AND a.usage_events > 0)""",
    "feature_shelfware_recent": """SELECT DISTINCT e.cust_id, e.product_id, f.feature_id
FROM src_entitlements e JOIN src_features f USING (product_id)
WHERE NOT EXISTS (SELECT 1 FROM src_feature_adoption a WHERE a.cust_id = e.cust_id AND a.product_id = e.product_id
                  AND a.feature_id = f.feature_id AND a.usage_events > 0 AND a.month >= DATE '2026-06-01')""",
    "component_categories": """SELECT cust_id, product_id, month,
       CASE WHEN lur < 0.1e0 THEN 'Shelfware' WHEN lur < 0.6e0 THEN 'Underutilized' WHEN lur < 1 THEN 'Healthy'
            WHEN lur <= 1.2e0 THEN 'Fully utilized' WHEN lur > 1.2e0 THEN 'Overage' END AS utilization_category,
       CASE WHEN feature_adoption < 0.25e0 THEN 'Narrow' WHEN feature_adoption < 0.5e0 THEN 'Partial'
            WHEN feature_adoption <= 0.75e0 THEN 'Broad' WHEN feature_adoption > 0.75e0 THEN 'Broad + deep'
       END AS feature_category,
       CASE WHEN sustained_usage >= 1 THEN 'Durable' WHEN sustained_usage >= 0.5e0 THEN 'Recent'
            WHEN sustained_usage > 0 THEN 'Churn signal' WHEN sustained_usage = 0 THEN 'Dormant' END AS sustained_category,
       CASE WHEN ttv_score IS NULL THEN 'Grace period' WHEN ttv_days <= 30 THEN 'Fast' WHEN ttv_days <= 90 THEN 'Slow'
            ELSE 'Onboarding stall' END AS speed_category FROM m_mart""",
    "params_override": f"SELECT * FROM ({mart(OVERRIDDEN, source='m_sku_attributes')})",
    "mart_parameters": f"""SELECT segment, product_platform, month, {", ".join(f"{RULED[n]} AS param_{n}" for n in sorted(RULED))}
FROM (SELECT DISTINCT segment, product_platform FROM src_entitlements JOIN src_customers USING (cust_id)
      JOIN src_products USING (product_id)), star_months
WHERE month >= (SELECT min(month) FROM src_consumption) AND month <= (SELECT max(month) FROM src_consumption)""",
    "sku_mart_override": "SELECT * FROM r_mart",
    "feature_mart_override": """SELECT cust_id, product_id, feature_id, feature_name, month, usage_events, feature_score,
       CASE plain WHEN 0e0 THEN 'not_enabled' WHEN 0.3e0 THEN 'enabled_idle' WHEN 0.7e0 THEN 'active' ELSE 'deep' END AS adoption_level
FROM r_feature""",
    "customer_month_override": f"""SELECT cust_id, cust_name, segment, region, month, {_ROLL.replace("vrs < 50", "vrs < middle")},
       {r("sum(vrs::DECIMAL(5,1))::DOUBLE / count(vrs)", 1)} AS vrs_simple_avg, count(*) AS skus
FROM r_full GROUP BY cust_id, cust_name, segment, region, month""",
    "portfolio_kpis_override": f"SELECT * EXCLUDE (month) FROM ({kpi_sql('r_full', 'middle')}) WHERE {AT}",
    "band_mix_override": _MIX_RULED,
    "dq_report_override": dq_of("r_mart", "r_full"),
    "dq_report_capped": dq_of("c_mart", "c_full"),
    "smooth_curve": f"SELECT * FROM ({mart(parameters(SMOOTH_ACTIVATION))})",
    "overage_cap_60": f"SELECT * FROM ({mart(parameters(HARSH_OVERAGE))})",
    "ttv_first_signal": f"SELECT * FROM ({mart(parameters(), first='m_first_signal')})",
    "naive_utilization": f"""SELECT cust_id, product_id, month,
       {r("(sum(consumed_units::DECIMAL(30,9)) OVER w)::DOUBLE / (sum(licensed_amount) OVER w)::DOUBLE", 6)} AS naive_utilization
FROM m_sku WINDOW w AS (PARTITION BY cust_id, product_id ORDER BY month ROWS UNBOUNDED PRECEDING)""",
    "peer_percentile": f"""SELECT cust_id, product_id, month, vrs,
       {r("percent_rank() OVER (PARTITION BY month, product_id ORDER BY vrs)", 6)} AS peer_percentile FROM m_mart""",
    "at_risk_share": f"""SELECT month, arr, at_risk_arr, {r("at_risk_arr / nullif(arr, 0) * 1e2", 2)} AS at_risk_pct
FROM m_kpi ORDER BY month""",
}

ORACLES = {name: query(select) for name, select in SELECTS.items()}
