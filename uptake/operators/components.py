"""Three of the four score components, per SKU and month.

Shuffle plan: both inputs of the join are aggregates by (customer, product,
month) and so already partitioned alike; the window adds one exchange by
(customer, product). A window group is one SKU and has as many rows as there
are months, whatever the number of raw rows behind it. All frames share one
window specification and become one Window node.
"""

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from uptake.functions import scoring
from uptake.operators.staging import SKU, SKU_MONTH
from uptake.params import DEFAULTS, ScoreParams

COMPONENT_COLUMNS = [
    *SKU_MONTH,
    "consumed_units",
    "licensed_amount",
    "lur",
    "util_health",
    "feature_adoption",
    "sustained_usage",
    "prior_lur",
    "ever_active_before",
]


def sku_history() -> WindowSpec:
    """The rows of one SKU in month order."""
    return Window.partitionBy(*SKU).orderBy("month")


def with_history(stg_sku_month: DataFrame, fa: DataFrame, p: ScoreParams = DEFAULTS) -> DataFrame:
    """Components plus ``first_value_month``; extra columns of the input pass through.

    Frames count rows, not calendar months: a missing month shortens the memory.
    """
    base = (
        stg_sku_month.join(fa, SKU_MONTH, "left")
        .withColumn("feature_adoption", F.coalesce("feature_adoption", F.lit(0.0)))
        .withColumn("util_health", scoring.utilization_health(F.col("lur"), p))
        .withColumn("active", scoring.in_use(F.col("lur"), p))
    )
    history = sku_history()
    before = history.rowsBetween(Window.unboundedPreceding, -1)
    whole = history.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seen = base.select(
        "*",
        F.lag("active", 1).over(history).alias("back1"),
        F.lag("active", 2).over(history).alias("back2"),
        F.avg("lur").over(history.rowsBetween(-3, -1)).alias("prior_lur"),
        F.coalesce(F.max("active").over(before), F.lit(0)).alias("ever_active_before"),
        F.min(F.when(F.col("active") == 1, F.col("month"))).over(whole).alias("first_value_month"),
    )
    return seen.withColumn(
        "sustained_usage", scoring.sustained_usage(F.col("active"), F.col("back1"), F.col("back2"), p)
    ).drop("active", "back1", "back2")


def sku_components(stg_sku_month: DataFrame, fa: DataFrame, p: ScoreParams = DEFAULTS) -> DataFrame:
    return with_history(stg_sku_month, fa, p).select(*COMPONENT_COLUMNS)
