"""Monthly staging: overlapping contracts resolved, features graded.

Usage combines on the map side before it shuffles, so a customer or product
that holds a large part of all rows reaches the reducers as one row per map
task and month. Feature events are dealt by SKU and month instead, so that their
sums and the mean of their grades need one exchange; a large customer or
product is spread over its SKUs and months.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.functions import scoring
from uptake.functions.numeric import UNITS, exact_sum, ratio
from uptake.params import DEFAULTS, ScoreParams

SKU = ["cust_id", "product_id"]
SKU_MONTH = [*SKU, "month"]


def sku_month(consumption: DataFrame) -> DataFrame:
    """Consumed and licensed summed over concurrent contracts, then divided."""
    return (
        consumption.groupBy(*SKU_MONTH)
        .agg(
            exact_sum(F.col("consumed_units"), UNITS).cast("double").alias("consumed_units"),
            F.sum("licensed_amount").alias("licensed_amount"),
        )
        .withColumn("lur", ratio(F.col("consumed_units"), F.col("licensed_amount")))
    )


def feature_month(
    feature_adoption: DataFrame, features: DataFrame, p: ScoreParams = DEFAULTS, attributes: tuple[str, ...] = ()
) -> DataFrame:
    """Events summed over concurrent contracts, then graded by the feature's own thresholds.

    ``attributes`` are columns of the SKU that the parameters depend on.
    The feature table carries no broadcast hint: Catalyst and AQE broadcast it
    when its measured size allows, else they sort-merge and split hot features.
    """
    return grade(feature_events(feature_adoption, attributes), features, p)


def feature_events(feature_adoption: DataFrame, attributes: tuple[str, ...] = ()) -> DataFrame:
    """Events summed over concurrent contracts, dealt by SKU and month as ``feature_adoption_avg`` needs them.

    A contract has one row a feature and month, so a fold before the exchange would find next to nothing to sum.
    """
    return feature_adoption.repartition(*SKU_MONTH).groupBy(*SKU, "feature_id", "month", *attributes).agg(F.sum("usage_events").alias("usage_events"))


def grade(events: DataFrame, features: DataFrame, p: ScoreParams = DEFAULTS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Summed events graded by the feature's own thresholds; ``keep`` are further columns of ``events`` to pass on."""
    thresholds = features.select("feature_id", "feature_name", "meaningful_floor_events", "deep_threshold_events")
    return events.join(thresholds, "feature_id").select(
        *SKU,
        "feature_id",
        "month",
        "feature_name",
        "usage_events",
        scoring.feature_points(
            F.col("usage_events"), F.col("meaningful_floor_events"), F.col("deep_threshold_events"), p
        ).alias("feature_score"),
        *keep,
    )


def feature_adoption_avg(graded: DataFrame) -> DataFrame:
    """Mean grade per SKU-month; a feature without use counts as 0."""
    return graded.groupBy(*SKU_MONTH).agg(
        scoring.mean_of_points(F.col("feature_score")).alias("feature_adoption")
    )
