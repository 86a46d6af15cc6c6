"""Account queries: plays, worklists and drill-downs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake import vocabulary as v
from uptake.functions import labels, scoring
from uptake.functions.numeric import MONEY, headline_score, signal, total, total_where
from uptake.operators.filters import EVERYTHING, Filters, as_of
from uptake.params import DEFAULTS, ScoreParams

SIGNALS = ["util_health", "feature_adoption", "sustained_usage", "ttv_score"]


def signals() -> list[Column]:
    """The four components, revenue-weighted over the rows where they are known."""
    return [signal(F.col(name), F.col("arr")).alias(name) for name in SIGNALS]


def at_risk_revenue() -> Column:
    return total_where(scoring.at_risk(F.col("vrs")), F.col("arr"))


def account_facts() -> list[Column]:
    return [
        labels.any_collapse().alias("collapse"),
        labels.any_shelfware().alias("shelfware"),
        labels.any_expansion().alias("expansion"),
    ]


def _play() -> Column:
    return labels.play(F.col("collapse"), F.col("shelfware"), F.col("expansion"))


# ---- plays ----------------------------------------------------------------


def play_of_customer(full: DataFrame, month: str, filters: Filters = EVERYTHING) -> DataFrame:
    """The one play of each account, its owner and the advice text."""
    accounts = (
        filters.apply(as_of(full, month))
        .groupBy("cust_id")
        .agg(*account_facts(), labels.largest_overage().alias("max_overage_lur"))
        .withColumn("play", _play())
    )
    return accounts.select(
        "cust_id",
        "play",
        labels.play_owner(F.col("play")).alias("owner"),
        "max_overage_lur",
        labels.play_advice(F.col("play"), F.col("max_overage_lur")).alias("advice"),
    )


def play_catalog(full: DataFrame, month: str, filters: Filters = EVERYTHING) -> DataFrame:
    """The three plays and their triggers, with the accounts and revenue they reach.

    Revenue counts the rows that trigger a play; a row may trigger two plays.
    """
    triggers = {
        "Activate": F.col("state") == v.SHELFWARE,
        "Win back": F.col("state").isin(v.CHURN, v.LAPSED),
        "Upsell": F.coalesce("flag_expansion", F.lit(False)),
    }
    arr = F.col("arr").cast(MONEY)
    accounts = (
        filters.apply(as_of(full, month))
        .groupBy("cust_id")
        .agg(
            *[F.bool_or(test).alias(f"has {play}") for play, test in triggers.items()],
            *[F.sum(F.when(test, arr)).alias(f"arr {play}") for play, test in triggers.items()],
        )
    )
    sums = accounts.agg(
        *[F.count_if(F.col(f"has {play}")).alias(f"has {play}") for play in triggers],
        *[F.sum(f"arr {play}").cast("double").alias(f"arr {play}") for play in triggers],
    )
    columns = ("play", "owner", "trigger_type", "trigger", "kind", "addresses")
    rows = [
        F.struct(
            *[F.lit(value).alias(name) for name, value in zip(columns, play, strict=True)],
            F.col(f"has {play[0]}").alias("accounts"),
            F.coalesce(F.col(f"arr {play[0]}"), F.lit(0.0)).alias("arr"),
        )
        for play in v.PLAYS
    ]
    return sums.select(F.inline(F.array(*rows)))


# ---- account roll-ups -----------------------------------------------------


def _summary(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.groupBy("cust_id", "cust_name", "segment", "region").agg(
        headline_score(F.col("vrs"), F.col("arr")).alias("vrs"),
        *signals(),
        total(F.col("arr")).alias("total_arr"),
        at_risk_revenue().alias("arr_at_risk"),
        *more,
    )


def customer_summary(full: DataFrame, month: str, filters: Filters = EVERYTHING) -> DataFrame:
    return _summary(filters.apply(as_of(full, month)))


def customer_kpis(full: DataFrame, month: str, filters: Filters = EVERYTHING, p: ScoreParams = DEFAULTS) -> DataFrame:
    """At-risk and expansion revenue with their accounts, and accounts with either.

    One row per customer first, so the distinct counts are plain counts.
    """
    risky = F.coalesce(scoring.at_risk(F.col("vrs"), p), F.lit(False))
    growing = F.coalesce("flag_expansion", F.lit(False))
    arr = F.col("arr").cast(MONEY)
    accounts = (
        filters.apply(as_of(full, month))
        .groupBy("cust_id")
        .agg(
            F.sum(F.when(risky, arr)).alias("risk_arr"),
            F.sum(F.when(growing, arr)).alias("growth_arr"),
            F.bool_or(risky).alias("risky"),
            F.bool_or(growing).alias("growing"),
        )
    )
    return accounts.agg(
        F.coalesce(F.sum("risk_arr").cast("double"), F.lit(0.0)).alias("at_risk_arr"),
        F.count_if("risky").alias("at_risk_accounts"),
        F.coalesce(F.sum("growth_arr").cast("double"), F.lit(0.0)).alias("expansion_arr"),
        F.count_if("growing").alias("expansion_accounts"),
        F.count_if(F.col("risky") | F.col("growing")).alias("accounts_needing_action"),
        F.count("*").alias("customers"),
    )


def play_worklist(
    full: DataFrame, month: str, play: str | None = None, filters: Filters = EVERYTHING
) -> DataFrame:
    """Accounts at risk or expanding that have a play, most revenue at risk first."""
    wanted = F.bool_or(
        F.coalesce(scoring.at_risk(F.col("vrs")), F.lit(False)) | F.coalesce("flag_expansion", F.lit(False))
    )
    accounts = (
        _summary(filters.apply(as_of(full, month)), *account_facts(), wanted.alias("wanted"))
        .where("wanted")
        .withColumn("play", _play())
        .where(F.col("play").isNotNull())
    )
    if play is not None:
        accounts = accounts.where(F.col("play") == play)
    return accounts.select(
        "cust_id",
        "cust_name",
        "segment",
        "play",
        labels.play_owner(F.col("play")).alias("owner"),
        "vrs",
        *SIGNALS,
        "total_arr",
        "arr_at_risk",
    ).orderBy(F.desc("arr_at_risk"), F.desc("total_arr"), "cust_id")


def anomaly_of_customer(rows: DataFrame) -> DataFrame:
    """Most urgent anomaly of each account among the given rows."""
    return (
        rows.groupBy("cust_id")
        .agg(*account_facts(), labels.any_fragile().alias("single"))
        .select(
            "cust_id",
            labels.anomaly(F.col("collapse"), F.col("shelfware"), F.col("expansion"), F.col("single")).alias("anomaly"),
        )
    )


def anomaly_label(full: DataFrame, month: str, filters: Filters = EVERYTHING) -> DataFrame:
    return anomaly_of_customer(filters.apply(as_of(full, month)))


# ---- drill-downs ----------------------------------------------------------


def customer_names(full: DataFrame, month: str, filters: Filters = EVERYTHING) -> DataFrame:
    return filters.apply(as_of(full, month)).select("cust_name").distinct().orderBy("cust_name")


def customer_products(
    full: DataFrame, cust_id: str, month: str, filters: Filters = EVERYTHING, p: ScoreParams = DEFAULTS
) -> DataFrame:
    """Products of one account, worst score first; the state shown is the score band."""
    return (
        filters.apply(as_of(full, month))
        .where(F.col("cust_id") == cust_id)
        .select(
            "product_name",
            labels.platform_label(F.col("product_platform")).alias("platform"),
            "vrs",
            scoring.band(F.col("vrs"), p).alias("state"),
            *SIGNALS,
            "arr",
        )
        .orderBy("vrs", "product_name")
    )


def feature_detail(feature_month: DataFrame, cust_id: str, product_id: str, month: str) -> DataFrame:
    """Features of one SKU in one month, deepest first."""
    return (
        as_of(feature_month, month)
        .where((F.col("cust_id") == cust_id) & (F.col("product_id") == product_id))
        .select("feature_name", "usage_events", "feature_score", "adoption_level")
        .orderBy(F.desc("feature_score"), "feature_name")
    )


def sku_series(sku_month: DataFrame, cust_id: str, product_id: str) -> DataFrame:
    """Utilization, score and state of one SKU over time."""
    return (
        sku_month.where((F.col("cust_id") == cust_id) & (F.col("product_id") == product_id))
        .select("month", "lur", "vrs", "state")
        .orderBy("month")
    )
