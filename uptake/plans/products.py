"""Product queries: platform cards, the model table and a model's customers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uptake import vocabulary as v
from uptake.functions import labels, scoring
from uptake.functions.numeric import MONEY, SCORE, SIGNAL, headline_score, ratio, rnd, total
from uptake.operators.filters import EVERYTHING, Filters, as_of
from uptake.plans.customers import SIGNALS, account_facts, at_risk_revenue, signals


def platform_cards(full: DataFrame, month: str, filters: Filters = EVERYTHING) -> DataFrame:
    """Score, revenue and share at risk per platform, in the cards' order; other platforms come last."""
    cards = (
        filters.apply(as_of(full, month))
        .groupBy("product_platform")
        .agg(
            headline_score(F.col("vrs"), F.col("arr")).alias("vrs"),
            total(F.col("arr")).alias("arr"),
            at_risk_revenue().alias("arr_at_risk"),
        )
    )
    share = F.coalesce(ratio(F.col("arr_at_risk"), F.col("arr")) * F.lit(100.0), F.lit(0.0))
    place = F.array_position(F.array(*[F.lit(code) for code in v.CARD_ORDER]), F.col("product_platform"))
    return cards.select(
        "product_platform",
        labels.platform_label(F.col("product_platform")).alias("platform"),
        "vrs",
        "arr",
        "arr_at_risk",
        rnd(share, 2).alias("at_risk_pct"),
    ).orderBy(F.when(place > 0, place).asc_nulls_last(), "product_platform")


def product_model_table(
    full: DataFrame, month: str, platform: str | None = None, filters: Filters = EVERYTHING
) -> DataFrame:
    """Per platform and product model: signals, revenue and anomaly counts.

    Rows are first folded to one per model and customer. The counts of distinct
    customers are then counts of rows, where several conditional distinct
    counts over the raw rows would multiply them before the shuffle.
    """
    rows = filters.apply(as_of(full, month)).withColumn("model", labels.model_name(F.col("product_name")))
    if platform is not None:
        rows = rows.where(F.col("product_platform") == platform)
    arr = F.col("arr").cast(MONEY)
    sums = {
        "points": F.sum(F.col("vrs").cast(SCORE) * arr),
        "arr": F.sum(arr),
        "risk_arr": F.sum(F.when(scoring.at_risk(F.col("vrs")), arr)),
    }
    for name in SIGNALS:
        sums[f"{name}_points"] = F.sum(F.col(name).cast(SIGNAL) * arr)
        sums[f"{name}_arr"] = F.sum(F.when(F.col(name).isNotNull(), arr))
    per_customer = rows.groupBy("product_platform", "model", "cust_id").agg(
        *[expr.alias(name) for name, expr in sums.items()], *account_facts()
    )
    models = per_customer.groupBy("product_platform", "model").agg(
        *[F.sum(name).alias(name) for name in sums],
        F.count_if("shelfware").alias("shelfware_accounts"),
        F.count_if("collapse").alias("drop_accounts"),
        F.count_if("expansion").alias("overage_accounts"),
    )

    def as_double(name: str) -> Column:
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0))

    text = labels.anomaly_counts_text(
        F.col("shelfware_accounts"), F.col("drop_accounts"), F.col("overage_accounts")
    )
    return models.select(
        "product_platform",
        labels.platform_label(F.col("product_platform")).alias("platform"),
        "model",
        F.coalesce(rnd(ratio(F.col("points"), F.col("arr")), 1), F.lit(0.0)).alias("vrs"),
        *[rnd(ratio(F.col(f"{n}_points"), F.col(f"{n}_arr")), 2).alias(n) for n in SIGNALS],
        as_double("arr").alias("arr"),
        as_double("risk_arr").alias("arr_at_risk"),
        "shelfware_accounts",
        "drop_accounts",
        "overage_accounts",
        text.alias("anomalies"),
    ).orderBy(F.desc("arr_at_risk"), "product_platform", "model")


def model_customers(
    full: DataFrame, platform: str, model: str, month: str, filters: Filters = EVERYTHING
) -> DataFrame:
    """Customers on one product model, worst score first, each with its anomaly."""
    rows = filters.apply(as_of(full, month)).where(
        (F.col("product_platform") == platform) & (labels.model_name(F.col("product_name")) == model)
    )
    accounts = rows.groupBy("cust_id", "cust_name", "segment", "region").agg(
        headline_score(F.col("vrs"), F.col("arr")).alias("vrs"),
        *signals(),
        total(F.col("arr")).alias("arr"),
        *account_facts(),
        labels.any_fragile().alias("single"),
    )
    anomaly = labels.anomaly(F.col("collapse"), F.col("shelfware"), F.col("expansion"), F.col("single"))
    return accounts.select(
        "cust_id", "cust_name", "segment", "region", anomaly.alias("anomaly"), "vrs", *SIGNALS, "arr"
    ).orderBy("vrs", "cust_id")
