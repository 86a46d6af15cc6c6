"""Expected volume of a feature and the thresholds derived from it."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from uptake.functions.numeric import rnd

FLOOR_SHARE = 0.20
DEEP_SHARE = 0.80
_CHUNK = 4096


def feature_thresholds(volume: Column) -> list[Column]:
    """Meaningful floor and deep threshold of an expected monthly volume."""
    return [
        rnd(F.lit(FLOOR_SHARE) * volume, 0).cast("long").alias("meaningful_floor_events"),
        rnd(F.lit(DEEP_SHARE) * volume, 0).cast("long").alias("deep_threshold_events"),
    ]


def expected_volume(feature_adoption: DataFrame) -> DataFrame:
    """Exact median of the monthly events among active users, per feature.

    The median is found in a histogram, first by chunks of 4096 values and then
    within the one or two chunks that hold the middle ranks. So no task sees
    the rows of a feature, only its chunk counts and at most two chunks.
    """
    histogram = (
        feature_adoption.where(F.col("usage_events") > 0)
        .groupBy("feature_id", F.col("usage_events").alias("events"))
        .agg(F.count("*").alias("n"))
        .withColumn("chunk", F.expr(f"events div {_CHUNK}"))
    )
    by_chunk = Window.partitionBy("feature_id").orderBy("chunk")
    whole = Window.partitionBy("feature_id")
    chunks = (
        histogram.groupBy("feature_id", "chunk")
        .agg(F.sum("n").alias("n"))
        .select(
            "feature_id",
            "chunk",
            (F.sum("n").over(by_chunk) - F.col("n")).alias("before"),
            F.sum("n").over(by_chunk).alias("through"),
            F.sum("n").over(whole).alias("users"),
        )
        .withColumn("low", F.expr("(users + 1) div 2"))
        .withColumn("high", F.expr("users div 2 + 1"))
        .where(
            F.col("low").between(F.col("before") + 1, F.col("through"))
            | F.col("high").between(F.col("before") + 1, F.col("through"))
        )
        .drop("through")
    )
    by_value = Window.partitionBy("feature_id", "chunk").orderBy("events")
    middle = histogram.join(chunks, ["feature_id", "chunk"]).withColumn(
        "through", F.col("before") + F.sum("n").over(by_value)
    )
    holds_low = F.col("low").between(F.col("through") - F.col("n") + 1, F.col("through"))
    holds_high = F.col("high").between(F.col("through") - F.col("n") + 1, F.col("through"))
    return middle.groupBy("feature_id").agg(
        (
            (F.max(F.when(holds_low, F.col("events"))) + F.max(F.when(holds_high, F.col("events")))) / F.lit(2.0)
        ).alias("expected_active_volume"),
        F.max("users").alias("active_user_months"),
    )
