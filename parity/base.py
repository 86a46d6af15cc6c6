"""Shared SQL for checking the Spark queries in DuckDB.

Each named relation lists the relations it reads; ``query`` puts in front of a
SELECT just the ones it needs. The SQL takes the direct way (self joins,
ordinary windows, distinct counts) where the Spark code takes the scalable one.
"""

import re

from uptake.params import DEFAULTS, ScoreParams

RELATIONS: dict[str, str] = {}


def relation(name: str, sql: str) -> None:
    RELATIONS[name] = sql


def query(select: str) -> str:
    """The SELECT with the relations it mentions, directly or not, as CTEs."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in RELATIONS:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                visit(RELATIONS[name])
                if name not in needed:
                    needed.append(name)

    visit(select)
    ctes = ",\n".join(f"{name} AS ({RELATIONS[name]})" for name in needed)
    return f"WITH {ctes}\n{select}" if ctes else select


# ---- expressions ----------------------------------------------------------


def num(value: float) -> str:
    """A DOUBLE literal; plain 0.3 would be a decimal."""
    return f"{float(value)!r}e0"


def r(expr: str, places: int) -> str:
    return f"(floor(({expr}) * 1e{places} + 0.5e0) / 1e{places})"


def rs(expr: str, places: int) -> str:
    size = r(f"abs({expr})", places)
    return f"(CASE WHEN ({expr}) < 0 AND {size} > 0 THEN -{size} ELSE {size} END)"


MONEY = "arr::DECIMAL(18,2)"
POINTS = f"vrs::DECIMAL(5,1) * {MONEY}"


def total(test: str | None = None) -> str:
    inner = MONEY if test is None else f"CASE WHEN {test} THEN {MONEY} END"
    return f"coalesce(sum({inner})::DOUBLE, 0e0)"


WMEAN = f"(sum({POINTS})::DOUBLE / nullif(sum({MONEY})::DOUBLE, 0))"
SCORE = f"coalesce({r(WMEAN, 1)}, 0e0)"


def signal(column: str) -> str:
    known = f"sum(CASE WHEN {column} IS NOT NULL THEN {MONEY} END)::DOUBLE"
    return r(f"sum({column}::DECIMAL(6,3) * {MONEY})::DOUBLE / nullif({known}, 0)", 2)


SIGNAL_NAMES = ("util_health", "feature_adoption", "sustained_usage", "ttv_score")
SIGNALS = ", ".join(f"{signal(c)} AS {c}" for c in SIGNAL_NAMES)


def band(x: str, middle: str = "50") -> str:
    return (
        f"CASE WHEN {x} >= 70 THEN 'Value Realized' WHEN {x} >= {middle} THEN 'Developing' "
        f"WHEN {x} >= 30 THEN 'At Risk' ELSE 'Critical' END"
    )


COLLAPSE = "coalesce(bool_or(state IN ('Churn Signal', 'Lapsed')), false)"
SHELFWARE = "coalesce(bool_or(state = 'Shelfware Risk'), false)"
EXPANSION = "coalesce(bool_or(flag_expansion), false)"
FRAGILE = "coalesce(bool_or(flag_single_feature_dependency), false)"
PLAY = f"CASE WHEN {COLLAPSE} THEN 'Win back' WHEN {SHELFWARE} THEN 'Activate' WHEN {EXPANSION} THEN 'Upsell' END"
ANOMALY = (
    f"CASE WHEN {SHELFWARE} THEN 'Shelfware' WHEN {COLLAPSE} THEN 'Spike & drop' "
    f"WHEN {EXPANSION} THEN 'Overage (upsell)' WHEN {FRAGILE} THEN 'Single Feature Flag' ELSE '—' END"
)


def owner(play: str) -> str:
    return (
        f"CASE {play} WHEN 'Win back' THEN 'Account teams' WHEN 'Activate' THEN 'Customer Success' "
        "WHEN 'Upsell' THEN 'Sales' END"
    )


def advice(play: str, overage: str) -> str:
    percent = f"{r(f'{overage} * 1e2', 0)}::BIGINT::VARCHAR"
    return (
        f"CASE {play} WHEN 'Win back' THEN 'Win back · Account teams' "
        f"WHEN 'Activate' THEN 'Activate · Customer Success' "
        f"WHEN 'Upsell' THEN 'Upsell · Sales (overage ' || {percent} || '%)' ELSE '— monitor' END"
    )


def platform(code: str) -> str:
    return (
        f"CASE {code} WHEN 'hardware_ngfw' THEN 'Hardware NGFW' WHEN 'software_ngfw' THEN 'Software NGFW' "
        f"WHEN 'sase' THEN 'SASE' WHEN 'cloud_ngfw' THEN 'Cloud NGFW' ELSE {code} END"
    )


MODEL = r"regexp_replace(product_name, '\s*SKU-\d+$', '')"

# ---- source tables --------------------------------------------------------

relation(
    "star_usage",
    """SELECT l_suppkey AS k, p_type, ((p_size - 1) // 13)::INTEGER AS sc,
       make_date(CASE WHEN month(l_shipdate) >= 7 THEN 2025 ELSE 2026 END, month(l_shipdate), 1) AS month,
       sum(l_quantity) AS qty, count(*) AS n
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
relation(
    "star_types",
    """SELECT p_type, code, ('0x' || code)::BIGINT AS num
FROM (SELECT DISTINCT p_type, substr(md5(p_type), 1, 8) AS code FROM part)""",
)
relation(
    "src_customers",
    """SELECT 'C' || s_suppkey AS cust_id, s_name AS cust_name, r_name AS region,
       CASE WHEN s_acctbal >= 4500 THEN 'Enterprise' ELSE 'Mid-Market' END AS segment,
       CASE WHEN s_suppkey % 20 IN (0, 1) THEN 'shelfware' WHEN s_suppkey % 20 IN (2, 3, 4) THEN 'overage'
            WHEN s_suppkey % 20 = 5 THEN 'spike_drop' WHEN s_suppkey % 20 = 6 THEN 'slow_onboarder'
            WHEN s_suppkey % 20 = 7 THEN 'intermittent' ELSE 'normal' END AS behavior_profile
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
relation(
    "src_products",
    """SELECT 'P' || code AS product_id, p_type || ' SKU-' || lpad((num % 10000)::VARCHAR, 4, '0') AS product_name,
       CASE num % 4 WHEN 0 THEN 'hardware_ngfw' WHEN 1 THEN 'software_ngfw' WHEN 2 THEN 'sase'
            ELSE 'cloud_ngfw' END AS product_platform,
       CASE num % 4 WHEN 0 THEN 'device_license' WHEN 1 THEN 'credits' WHEN 2 THEN 'seats'
            ELSE 'usage_units' END AS unit_of_measure
FROM star_types""",
)
relation(
    "src_features",
    """SELECT 'F' || code || '-' || sc AS feature_id, 'Size class ' || sc AS feature_name,
       'Size class ' || sc || ' of ' || p_type AS feature_description, 'P' || code AS product_id,
       3::BIGINT AS meaningful_floor_events, 6::BIGINT AS deep_threshold_events
FROM (SELECT DISTINCT p_type, ((p_size - 1) // 13)::INTEGER AS sc FROM part) JOIN star_types USING (p_type)""",
)
relation(
    "star_contracts",
    """WITH observed AS (SELECT k, p_type, code, num, min(month) AS first_month
                  FROM star_usage JOIN star_types USING (p_type) GROUP BY ALL)
SELECT *, units * price AS arr, (start_date + INTERVAL 12 MONTH)::DATE AS end_date,
       'E' || k || '-' || code || CASE WHEN is_expansion THEN 'x' ELSE '' END AS entitlement_id,
       'C' || k AS cust_id, 'P' || code AS product_id
FROM (
  SELECT k, code, p_type, false AS is_expansion, (10 + 5 * (num % 6))::DOUBLE AS price,
         CASE WHEN k % 20 IN (0, 1) THEN 100000 WHEN k % 20 IN (2, 3, 4) THEN 40 WHEN k % 20 = 6 THEN 2500
              WHEN k % 20 = 7 THEN 600 ELSE 150 + 50 * ((k + num) % 4) END::BIGINT AS units,
         first_month AS start_date
  FROM observed
  UNION ALL
  SELECT k, code, p_type, true, (10 + 5 * (num % 6))::DOUBLE, CASE WHEN k % 20 = 5 THEN 20000 ELSE 400 END::BIGINT,
         DATE '2026-01-01'
  FROM observed WHERE k % 17 = 7 OR k % 20 = 5)""",
)
relation(
    "src_entitlements",
    """SELECT entitlement_id, product_id, cust_id, units AS units_purchased, units AS licensed_amount,
       price AS unit_price, arr, start_date, end_date, is_expansion FROM star_contracts""",
)
relation(
    "star_months",
    "SELECT unnest(generate_series(DATE '2025-07-01', DATE '2026-06-01', INTERVAL 1 MONTH))::DATE AS month",
)
relation(
    "star_spine",
    """SELECT c.*, m.month, date_diff('month', c.start_date, m.month) AS idx
FROM star_contracts c JOIN star_months m ON m.month >= c.start_date AND m.month < c.end_date""",
)
SHARED = "(k % 17 = 7 OR k % 20 = 5) AND s.month >= DATE '2026-01-01'"
relation(
    "src_consumption",
    f"""SELECT 'U-' || entitlement_id || '-' || strftime(s.month, '%Y%m') AS consumption_id,
       entitlement_id, cust_id, product_id, s.month,
       coalesce(qty, 0e0) * CASE WHEN {SHARED} THEN 0.5e0 ELSE 1e0 END AS consumed_units,
       units AS licensed_amount
FROM star_spine s
LEFT JOIN (SELECT k, p_type, month, sum(qty) AS qty FROM star_usage GROUP BY ALL) u USING (k, p_type, month)""",
)
relation(
    "src_feature_adoption",
    f"""SELECT 'A-' || entitlement_id || '-' || f.sc || '-' || strftime(s.month, '%Y%m') AS adoption_id,
       cust_id, entitlement_id, product_id, 'F' || code || '-' || f.sc AS feature_id, s.month,
       CASE WHEN NOT ({SHARED}) THEN coalesce(n, 0) WHEN is_expansion THEN coalesce(n, 0) // 2
            ELSE coalesce(n, 0) - coalesce(n, 0) // 2 END AS usage_events
FROM star_spine s
JOIN (SELECT DISTINCT k, p_type, sc FROM star_usage) f USING (k, p_type)
LEFT JOIN star_usage u USING (k, p_type, sc, month)""",
)

# ---- staging --------------------------------------------------------------

relation(
    "m_sku",
    """SELECT cust_id, product_id, month, sum(consumed_units::DECIMAL(30,9))::DOUBLE AS consumed_units,
       sum(licensed_amount)::BIGINT AS licensed_amount,
       sum(consumed_units::DECIMAL(30,9))::DOUBLE / nullif(sum(licensed_amount), 0)::DOUBLE AS lur
FROM src_consumption GROUP BY ALL""",
)
relation(
    "m_feature",
    """SELECT cust_id, product_id, feature_id, month, feature_name, events AS usage_events,
       CASE WHEN events = 0 THEN 0e0 WHEN events < meaningful_floor_events THEN 0.3e0
            WHEN events < deep_threshold_events THEN 0.7e0 ELSE 1e0 END AS feature_score
FROM (SELECT cust_id, product_id, feature_id, month, sum(usage_events)::BIGINT AS events
      FROM src_feature_adoption GROUP BY ALL)
JOIN (SELECT feature_id, feature_name, meaningful_floor_events, deep_threshold_events FROM src_features)
  USING (feature_id)""",
)
relation(
    "m_breadth",
    """SELECT cust_id, product_id, month,
       sum(round(feature_score * 1000)::BIGINT)::DOUBLE / (1000e0 * count(*)) AS feature_adoption
FROM m_feature GROUP BY ALL""",
)
relation(
    "m_start",
    """SELECT cust_id, product_id, min(start_date) AS start_date, sum(arr::DECIMAL(18,2))::DOUBLE AS arr
FROM src_entitlements GROUP BY ALL""",
)
relation(
    "m_first",
    "SELECT cust_id, product_id, min(month) AS first_value_month FROM m_sku WHERE lur >= 0.1e0 GROUP BY ALL",
)


# ---- components and the headline mart -------------------------------------


def components(p: dict[str, str], source: str, breadth: str = "m_breadth") -> str:
    """SQL of the components; ``p`` maps parameter names to SQL expressions.

    Rows of a SKU are numbered and earlier rows are found by number, where the
    Spark code uses window frames.
    """
    now, back1, back2 = (p[f"recency_{i}"] for i in range(3))

    def known(alias: str, weight: str) -> str:
        return f"CASE WHEN {alias}.active IS NULL THEN 0e0 ELSE {weight} END"

    def earlier(alias: str, steps: int) -> str:
        return (
            f"LEFT JOIN numbered {alias} ON {alias}.cust_id = t.cust_id AND {alias}.product_id = t.product_id "
            f"AND {alias}.n = t.n - {steps}"
        )

    return f"""WITH numbered AS (
  SELECT s.*, coalesce(b.feature_adoption, 0e0) AS feature_adoption,
         row_number() OVER (PARTITION BY s.cust_id, s.product_id ORDER BY s.month) AS n,
         (lur >= {p["use_floor"]})::INTEGER AS active,
         CASE WHEN lur < {p["use_floor"]} THEN 0e0
              WHEN lur < {p["healthy_from"]} THEN {p["ramp_base"]} + (lur - {p["use_floor"]}) * {p["ramp_slope"]}
              WHEN lur < {p["full_from"]}
              THEN {p["healthy_base"]} + (lur - {p["healthy_from"]}) * {p["healthy_slope"]}
              WHEN lur <= {p["overage_above"]} THEN 1e0 ELSE {p["overage_score"]} END AS util_health
  FROM {source} s LEFT JOIN {breadth} b USING (cust_id, product_id, month))
SELECT t.* EXCLUDE (n, active),
       ({now} * t.active + {back1} * coalesce(x.active, 0) + {back2} * coalesce(y.active, 0))
       / ({now} + {known("x", back1)} + {known("y", back2)}) AS sustained_usage,
       (coalesce(z.lur, 0e0) + coalesce(y.lur, 0e0) + coalesce(x.lur, 0e0))
       / nullif((x.lur IS NOT NULL)::INT + (y.lur IS NOT NULL)::INT + (z.lur IS NOT NULL)::INT, 0) AS prior_lur,
       EXISTS (SELECT 1 FROM numbered o WHERE o.cust_id = t.cust_id AND o.product_id = t.product_id
               AND o.n < t.n AND o.active = 1)::INTEGER AS ever_active_before
FROM numbered t {earlier("x", 1)} {earlier("y", 2)} {earlier("z", 3)}"""


def parameters(p: ScoreParams = DEFAULTS, **overrides: str) -> dict[str, str]:
    values = {name: num(value) for name, value in vars(p).items()}
    return values | overrides


def mart(p: dict[str, str], source: str = "m_sku", first: str = "m_first", breadth: str = "m_breadth") -> str:
    """SQL of the headline mart under the given parameters."""
    lur_at = "c.lur"
    return f"""SELECT cust_id, product_id, month, {rs("lur", 3)} AS lur, {r("util_health", 3)} AS util_health,
       CASE WHEN has_features THEN {r("feature_adoption", 3)} END AS feature_adoption,
       {r("sustained_usage", 3)} AS sustained_usage,
       CASE WHEN NOT grace THEN {r("ttv_score", 3)} END AS ttv_score, ttv_days, ever_active_before, arr,
       {r("score", 1)} AS vrs, fragile AS flag_single_feature_dependency, expanding AS flag_expansion,
       CASE WHEN grace THEN 'Grace Period'
            WHEN coalesce(prior_lur, 0) >= 0.6e0 AND sustained_usage < 0.34e0 THEN 'Churn Signal'
            WHEN util_health = 0 THEN CASE WHEN ever_active_before = 1 THEN 'Lapsed' ELSE 'Shelfware Risk' END
            WHEN ttv_score < 0.5e0 AND feature_adoption < 0.3e0 THEN 'Onboarding Stall'
            ELSE {band("score", p["band_middle"])} END AS state
FROM (
  SELECT *, 100e0 * ({"{wu}"} * util_health + CASE WHEN has_features THEN {"{wf}"} * feature_adoption ELSE 0e0 END
                     + {"{ws}"} * sustained_usage + CASE WHEN grace THEN 0e0 ELSE {"{wt}"} * ttv_score END)
         / ({"{wu}"} + CASE WHEN has_features THEN {"{wf}"} ELSE 0e0 END + {"{ws}"}
            + CASE WHEN grace THEN 0e0 ELSE {"{wt}"} END) AS score
  FROM (
    SELECT c.*, e.arr, (c.product_id IN (SELECT product_id FROM src_features)) AS has_features,
           date_diff('day', e.start_date, f.first_value_month)::INTEGER AS ttv_days,
           CASE WHEN f.first_value_month IS NULL THEN 0e0
                WHEN f.first_value_month - e.start_date <= 30 THEN 1e0
                WHEN f.first_value_month - e.start_date <= 90
                THEN 1e0 - (f.first_value_month - e.start_date - 30e0) / 60e0 ELSE 0e0 END AS ttv_score,
           (date_trunc('month', e.start_date)::DATE = c.month AND c.util_health = 0) AS grace,
           (c.product_id IN (SELECT product_id FROM src_features)
            AND c.feature_adoption < 0.25e0 AND {lur_at} >= 0.9e0) AS fragile,
           {lur_at} > {p["overage_above"]} AS expanding
    FROM ({components(p, source, breadth)}) c
    JOIN m_start e USING (cust_id, product_id)
    LEFT JOIN {first} f USING (cust_id, product_id)))""".format(
        wu=p["weight_utilization"], wf=p["weight_features"], ws=p["weight_sustained"], wt=p["weight_speed"]
    )


relation("m_components", components(parameters(), "m_sku"))
relation("m_mart", mart(parameters()))
relation(
    "m_full",
    """SELECT m.* EXCLUDE (ttv_days), cust_name, segment, region, product_name, product_platform
FROM m_mart m JOIN src_customers USING (cust_id) JOIN src_products USING (product_id)""",
)
