"""The marts in a catalog: a namespace with a folder, tables by month whose months can be replaced, and stored views."""

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.functions.calendar import day
from uptake.functions.numeric import UNITS
from uptake.params import DEFAULTS, ScoreParams

#: The stored views and the tables they read. ``{ns}`` is the namespace; thresholds come from the parameters.
VIEWS = {
    "stg_sku_month": f"""
        SELECT cust_id, product_id, month, consumed_units, licensed_amount,
               try_divide(consumed_units, CAST(licensed_amount AS DOUBLE)) AS lur
        FROM (SELECT cust_id, product_id, month, CAST(sum(CAST(consumed_units AS {UNITS})) AS DOUBLE) AS consumed_units,
                     sum(licensed_amount) AS licensed_amount
              FROM {{ns}}.consumption GROUP BY cust_id, product_id, month)""",
    "stg_feature_month": """
        SELECT cust_id, product_id, feature_id, month, feature_name, usage_events,
               CASE WHEN usage_events = 0 THEN 0D WHEN usage_events < meaningful_floor_events THEN {p.feature_idle}D
                    WHEN usage_events < deep_threshold_events THEN {p.feature_active}D ELSE {p.feature_deep}D END AS feature_score
        FROM (SELECT cust_id, product_id, feature_id, month, sum(usage_events) AS usage_events
              FROM {ns}.feature_adoption GROUP BY cust_id, product_id, feature_id, month)
        JOIN (SELECT feature_id, feature_name, meaningful_floor_events, deep_threshold_events FROM {ns}.features) USING (feature_id)""",
}


def create_namespace(spark: SparkSession, name: str, folder: str | None = None) -> None:
    """A namespace, with its tables below ``folder`` if given, else where the catalog keeps them."""
    place = "" if folder is None else f" LOCATION '{folder}'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{place}")


def save(df: DataFrame, name: str) -> None:
    """The table ``name``, created or replaced; by month where it has one, rows sorted for look-ups as in ``write_by_month``."""
    if "month" not in df.columns:
        df.write.mode("overwrite").saveAsTable(name, format="parquet")
        return
    keys = [c for c in ("month", "cust_id", "product_id") if c in df.columns]
    sized = df.hint("rebalance", "month").sortWithinPartitions(*keys)
    sized.write.mode("overwrite").partitionBy("month").saveAsTable(name, format="parquet")


def replace_months(df: DataFrame, name: str, months: list[str]) -> None:
    """The rows of ``months`` in the table ``name`` become those of ``df``; a month without rows becomes empty.

    One static overwrite a month, so that no other month can be lost whatever the session's overwrite mode is.
    """
    spark = df.sparkSession
    columns = [c for c in spark.table(name).columns if c != "month"]
    for month in months:
        rows = df.where(F.col("month") == day(month)).select(*columns).hint("rebalance")
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (month = DATE '{day_text(month)}') SELECT * FROM {{rows}}", rows=rows)


def day_text(month: str) -> str:
    """The month as yyyy-mm-dd; anything else is an error, so that no other text reaches a statement."""
    year, number, first = (int(part) for part in month.split("-"))
    return f"{year:04d}-{number:02d}-{first:02d}"


def create_views(spark: SparkSession, namespace: str, p: ScoreParams = DEFAULTS, only: Iterable[str] = tuple(VIEWS)) -> None:
    """Views that the catalog stores; every session that shares it can read them."""
    for name in only:
        spark.sql(f"CREATE OR REPLACE VIEW {namespace}.{name} AS {VIEWS[name].format(ns=namespace, p=p)}")
