"""Explicit schemas of the six source tables and the derived tables."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

_TYPES = {
    "string": StringType(),
    "long": LongType(),
    "int": IntegerType(),
    "double": DoubleType(),
    "date": DateType(),
    "boolean": BooleanType(),
}


def schema(spec: str) -> StructType:
    pairs = (item.split(":") for item in spec.split())
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in pairs])


CUSTOMERS = schema("cust_id:string cust_name:string region:string segment:string behavior_profile:string")
PRODUCTS = schema("product_id:string product_name:string product_platform:string unit_of_measure:string")
ENTITLEMENTS = schema(
    "entitlement_id:string product_id:string cust_id:string units_purchased:long licensed_amount:long "
    "unit_price:double arr:double start_date:date end_date:date is_expansion:boolean"
)
FEATURES = schema(
    "feature_id:string feature_name:string feature_description:string product_id:string "
    "meaningful_floor_events:long deep_threshold_events:long"
)
CONSUMPTION = schema(
    "consumption_id:string entitlement_id:string cust_id:string product_id:string month:date "
    "consumed_units:double licensed_amount:long"
)
FEATURE_ADOPTION = schema(
    "adoption_id:string cust_id:string entitlement_id:string product_id:string feature_id:string "
    "month:date usage_events:long"
)

RAW = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "entitlements": ENTITLEMENTS,
    "features": FEATURES,
    "consumption": CONSUMPTION,
    "feature_adoption": FEATURE_ADOPTION,
}

SKU_MONTH = schema(
    "cust_id:string product_id:string month:date lur:double util_health:double feature_adoption:double "
    "sustained_usage:double ttv_score:double ttv_days:int ever_active_before:int arr:double vrs:double "
    "flag_single_feature_dependency:boolean flag_expansion:boolean state:string"
)
FEATURE_MONTH = schema(
    "cust_id:string product_id:string feature_id:string feature_name:string month:date usage_events:long "
    "feature_score:double adoption_level:string"
)
CUSTOMER_MONTH = schema(
    "cust_id:string cust_name:string segment:string region:string month:date vrs_arr_weighted:double "
    "vrs_simple_avg:double total_arr:double arr_at_risk:double skus:long"
)
PRODUCT_MONTH = schema(
    "product_id:string product_name:string product_platform:string month:date vrs_arr_weighted:double "
    "total_arr:double arr_at_risk:double customers:long"
)
SKU_MONTH_FULL = StructType(
    [f for f in SKU_MONTH if f.name != "ttv_days"]
    + schema("cust_name:string segment:string region:string product_name:string product_platform:string").fields
)
FEATURE_FULL = StructType([f for f in FEATURE_MONTH if f.name != "feature_id"])

MARTS = {
    "mart_customer_sku_month": SKU_MONTH,
    "mart_customer_feature_month": FEATURE_MONTH,
    "mart_customer_month": CUSTOMER_MONTH,
    "mart_product_month": PRODUCT_MONTH,
    "mart_sku_month_full": SKU_MONTH_FULL,
    "mart_feature_full": FEATURE_FULL,
}

CALENDAR = schema("month:date rows:long")

# The columns of the SKU mart whose presence and type the schema assertion counts.
SKU_MONTH_ASSERTED = StructType([f for f in SKU_MONTH if f.name not in ("ttv_days", "ever_active_before")])
