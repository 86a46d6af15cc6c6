"""Portfolio queries over the denormalised SKU mart (``mart_sku_month_full``).

The mart is partitioned by month, so an as-of query reads one partition, and
only the columns it names. Aggregates go through one row per customer, or one
row per month; no query gathers the rows of a group in one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake import vocabulary as v
from uptake.functions import labels, scoring
from uptake.functions.calendar import day, month_text
from uptake.functions.numeric import MONEY, SCORE, headline_score, ratio, rnd, rnd_signed, total, total_where, weighted_mean
from uptake.operators.filters import EVERYTHING, Filters, as_of
from uptake.params import DEFAULTS, ScoreParams

SNAPSHOT_COLUMNS = [
    "cust_id",
    "cust_name",
    "segment",
    "region",
    "product_id",
    "product_name",
    "product_platform",
    "vrs",
    "arr",
    "lur",
    "util_health",
    "feature_adoption",
    "sustained_usage",
    "ttv_score",
    "state",
    "flag_expansion",
    "flag_single_feature_dependency",
]
BAND_COLUMNS = {
    v.REALIZED: "value_realized",
    v.DEVELOPING: "developing",
    v.AT_RISK: "at_risk",
    v.CRITICAL: "critical",
}
MONTHS_SHOWN = 12
STILL_POINTS = 0.05


# ---- the calendar of the mart ---------------------------------------------


def calendar(full: DataFrame) -> DataFrame:
    """The mart's months and their rows. A build stores this, so that readers need not scan the mart to learn its months."""
    return full.groupBy("month").agg(F.count("*").alias("rows"))


def months(full: DataFrame) -> DataFrame:
    """The months of the mart or its stored calendar, as text."""
    return full.select("month").distinct().select(month_text(F.col("month")).alias("month")).orderBy("month")


def latest_month(full: DataFrame) -> DataFrame:
    return full.agg(F.max("month").alias("month"))


def month_before(full: DataFrame, month: str, steps: int = 1) -> Column:
    """The month ``steps`` positions earlier among those that exist; NULL if there is none."""
    earlier = full.where(F.col("month") < day(month)).select("month").distinct()
    nearest = earlier.orderBy(F.desc("month")).limit(steps)
    return nearest.agg(F.when(F.count("*") == steps, F.min("month"))).scalar()


# ---- rows and trends ------------------------------------------------------


def snapshot(full: DataFrame, month: str, filters: Filters = EVERYTHING) -> DataFrame:
    return filters.apply(as_of(full, month)).select(*SNAPSHOT_COLUMNS)


def portfolio_trend(full: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    score = weighted_mean(F.col("vrs"), F.col("arr"))
    return filters.apply(full).groupBy("month").agg(score.alias("vrs")).orderBy("month")


def risk_trend(full: DataFrame, filters: Filters = EVERYTHING, p: ScoreParams = DEFAULTS) -> DataFrame:
    lost = total_where(scoring.at_risk(F.col("vrs"), p), F.col("arr"))
    return filters.apply(full).groupBy("month").agg(lost.alias("arr_at_risk")).orderBy("month")


def band_trend(full: DataFrame, filters: Filters = EVERYTHING, p: ScoreParams = DEFAULTS) -> DataFrame:
    return (
        filters.apply(full)
        .groupBy("month", scoring.band(F.col("vrs"), p).alias("band"))
        .agg(total(F.col("arr")).alias("arr"))
        .orderBy("month", "band")
    )


# ---- headline figures -----------------------------------------------------

KPIS = {
    "vrs": "double",
    "arr": "double",
    "at_risk_arr": "double",
    "customers_at_risk": "long",
    "skus_at_risk": "long",
    "customers": "long",
    "expansion_arr": "double",
    "expansion_customers": "long",
}


def kpis_by_month(full: DataFrame, filters: Filters = EVERYTHING, p: ScoreParams = DEFAULTS) -> DataFrame:
    """The eight headline figures per month, through one row per customer and month.

    ``p`` may read columns of ``full`` and holds for rows; a customer's own score is judged by the default limit.

    Sums stay decimal between the two levels, so the detour changes no digit.
    """
    vrs, arr = F.col("vrs").cast(SCORE), F.col("arr").cast(MONEY)
    risky = scoring.at_risk(F.col("vrs"), p)
    expanding = F.coalesce(F.col("flag_expansion"), F.lit(False))
    accounts = (
        filters.apply(full)
        .groupBy("month", "cust_id")
        .agg(
            F.sum(vrs * arr).alias("points"),
            F.sum(arr).alias("arr"),
            F.sum(F.when(risky, arr)).alias("risk_arr"),
            F.count_if(risky).alias("risk_skus"),
            F.sum(F.when(expanding, arr)).alias("growth_arr"),
            F.bool_or(expanding).alias("growing"),
            headline_score(F.col("vrs"), F.col("arr")).alias("score"),
        )
    )

    def summed(name: str) -> Column:
        return F.coalesce(F.sum(name).cast("double"), F.lit(0.0))

    score = F.coalesce(rnd(ratio(F.sum("points"), F.sum("arr")), 1), F.lit(0.0))
    return accounts.groupBy("month").agg(
        score.alias("vrs"),
        summed("arr").alias("arr"),
        summed("risk_arr").alias("at_risk_arr"),
        F.count_if(scoring.at_risk(F.col("score"))).alias("customers_at_risk"),
        F.sum("risk_skus").alias("skus_at_risk"),
        F.count("*").alias("customers"),
        summed("growth_arr").alias("expansion_arr"),
        F.count_if("growing").alias("expansion_customers"),
    )


def portfolio_kpis(full: DataFrame, month: str, filters: Filters = EVERYTHING, p: ScoreParams = DEFAULTS) -> DataFrame:
    return kpis_by_month(as_of(full, month), filters, p).drop("month")


def at_risk_share(full: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    """At-risk revenue as a percentage of all revenue, per month."""
    kpi = kpis_by_month(full, filters)
    share = ratio(F.col("at_risk_arr"), F.col("arr")) * F.lit(100.0)
    return kpi.select("month", "arr", "at_risk_arr", rnd(share, 2).alias("at_risk_pct")).orderBy("month")


def kpi_movement(full: DataFrame, filters: Filters = EVERYTHING, known: DataFrame | None = None) -> DataFrame:
    """Headline figures with their change over one and three positions in the month list.

    The month list is that of the whole mart; a month the filters leave empty
    keeps its place and yields no difference. The window runs over one row per
    month. ``known`` is the stored calendar; without it the mart is asked.
    """
    listed = (full if known is None else known).select("month").distinct()
    per_month = listed.join(kpis_by_month(full, filters), "month", "left")
    order = Window.orderBy("month")
    moved = []
    for name, kind in KPIS.items():
        for suffix, steps in (("mom", 1), ("qoq", 3)):
            change = F.col(name) - F.lag(name, steps).over(order)
            moved.append((rnd_signed(change, 2) if kind == "double" else change).alias(f"{name}_{suffix}"))
    return per_month.select("month", *KPIS, *moved).orderBy("month")


# ---- bands ----------------------------------------------------------------


def _band_sums(p: ScoreParams = DEFAULTS) -> list[Column]:
    """Revenue per band as one column each; absent bands are 0."""
    band = scoring.band(F.col("vrs"), p)
    return [total_where(band == name, F.col("arr")).alias(column) for name, column in BAND_COLUMNS.items()]


def _all_bands() -> Column:
    first, *others = [F.col(c) for c in BAND_COLUMNS.values()]
    for other in others:
        first = first + other
    return first


def band_mix(full: DataFrame, month: str, filters: Filters = EVERYTHING, p: ScoreParams = DEFAULTS) -> DataFrame:
    """Revenue and share per band; always four rows."""
    sums = filters.apply(as_of(full, month)).agg(*_band_sums(p)).withColumn("all", _all_bands())
    rows = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.lit(name).alias("band"),
            F.col(column).alias("arr"),
            rnd(ratio(F.col(column), F.col("all")) * F.lit(100.0), 2).alias("share_pct"),
        )
        for i, (name, column) in enumerate(BAND_COLUMNS.items())
    ]
    return sums.select(F.inline(F.array(*rows))).orderBy("position")


def band_shares(full: DataFrame, filters: Filters = EVERYTHING) -> DataFrame:
    """Unrounded share of each band in the month's revenue, one row per month."""
    sums = filters.apply(full).groupBy("month").agg(*_band_sums()).withColumn("all", _all_bands())
    return sums.select(
        "month", *[(ratio(F.col(c), F.col("all")) * F.lit(100.0)).alias(c) for c in BAND_COLUMNS.values()]
    )


def band_share_history(full: DataFrame, filters: Filters = EVERYTHING, last: int = MONTHS_SHOWN) -> DataFrame:
    """Band shares of the latest twelve months."""
    shares = band_shares(full, filters).orderBy(F.desc("month")).limit(last)
    return shares.select("month", *[rnd(F.col(c), 4).alias(c) for c in BAND_COLUMNS.values()]).orderBy("month")


def band_share_change_qoq(
    full: DataFrame, month: str, filters: Filters = EVERYTHING, known: DataFrame | None = None
) -> DataFrame:
    """Change of each band's share against three positions earlier, in points; ``known`` is the stored calendar."""
    quarter = month_before(full if known is None else known, month, 3)
    both = full.where((F.col("month") == day(month)) | (F.col("month") == quarter))
    shares = band_shares(both, filters)
    is_now = F.col("month") == day(month)
    pairs = [
        F.max(F.when(test, F.col(c))).alias(f"{c}_{tag}")
        for c in BAND_COLUMNS.values()
        for tag, test in (("now", is_now), ("then", ~is_now))
    ]
    rows = []
    for name, c in BAND_COLUMNS.items():
        change = rnd_signed(F.col(f"{c}_now") - F.col(f"{c}_then"), 4)
        rows.append(
            F.struct(
                F.lit(name).alias("band"),
                rnd(F.col(f"{c}_now"), 4).alias("share_now"),
                rnd(F.col(f"{c}_then"), 4).alias("share_quarter_ago"),
                change.alias("change_pts"),
                labels.direction(change, STILL_POINTS).alias("direction"),
            )
        )
    return shares.agg(*pairs).select(F.inline(F.array(*rows)))


# ---- movers ---------------------------------------------------------------


def top_movers(
    full: DataFrame, month: str, filters: Filters = EVERYTHING, top: int = 7, known: DataFrame | None = None
) -> DataFrame:
    """Largest score swings against the previous month, accounts with a play first.

    Both months are read in one scan and folded into one row per customer;
    customers missing from either month drop out. ``known`` is the stored calendar.
    """
    now = F.col("month") == day(month)
    both = full.where(now | (F.col("month") == month_before(full if known is None else known, month, 1)))

    def score(test: Column) -> Column:
        arr = F.when(test, F.col("arr"))
        return headline_score(F.when(test, F.col("vrs")), arr)

    state, expanding = F.col("state"), F.coalesce(F.col("flag_expansion"), F.lit(False))
    accounts = (
        filters.apply(both)
        .groupBy("cust_id")
        .agg(
            F.max(F.when(now, F.col("cust_name"))).alias("cust_name"),
            score(now).alias("vrs"),
            score(~now).alias("vrs_prev"),
            total_where(now, F.col("arr")).alias("arr"),
            F.bool_or(now).alias("present"),
            F.bool_or(~now).alias("was_present"),
            F.bool_or(now & state.isin(v.CHURN, v.LAPSED)).alias("collapse"),
            F.bool_or(now & (state == v.SHELFWARE)).alias("shelfware"),
            F.bool_or(now & expanding).alias("expansion"),
            F.max(F.when(now & expanding, F.col("lur"))).alias("overage"),
        )
        .where(F.col("present") & F.col("was_present"))
    )
    play = labels.play(F.col("collapse"), F.col("shelfware"), F.col("expansion"))
    delta = rnd_signed(F.col("vrs") - F.col("vrs_prev"), 1)
    return (
        accounts.withColumn("delta", delta)
        .orderBy(play.isNotNull().desc(), F.abs("delta").desc(), F.col("cust_id"))
        .limit(top)
        .select(
            "cust_id",
            "cust_name",
            "vrs",
            "vrs_prev",
            "delta",
            labels.direction(F.col("delta")).alias("direction"),
            "arr",
            scoring.band(F.col("vrs")).alias("band"),
            labels.play_advice(play, F.col("overage")).alias("play"),
        )
    )


# ---- states ---------------------------------------------------------------


def state_distribution(full: DataFrame) -> DataFrame:
    """Distinct customers per state over the whole history."""
    return (
        full.groupBy("state")
        .agg(F.countDistinct("cust_id").alias("customers"))
        .orderBy(F.desc("customers"), "state")
    )
