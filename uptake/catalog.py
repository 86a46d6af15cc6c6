"""Every query by name, over the tables in one folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from uptake import register, schemas
from uptake.functions.calendar import day
from uptake.functions.numeric import rnd
from uptake.operators import components, contracts, keys, staging, volumes
from uptake.operators.filters import Filters
from uptake.params import DEFAULTS, HARSH_OVERAGE, Override
from uptake.register import Rule
from uptake.plans import customers, extensions, marts, monthly, portfolio, products, quality
from uptake.sources import tables, warehouse
from uptake.sources.shared import fresh_folder
from uptake.sources.star import FIRST_MONTH, FROM_USAGE, LAST_MONTH, MONTHS, Star
from uptake.sources.store import Store
from uptake.sources.tables import conform, read_csv, write_csv

AS_OF = LAST_MONTH
MONTH_BEFORE = "2026-05-01"
SOME = Filters(segments=("Enterprise",), regions=("ASIA", "EUROPE", "AMERICA"), platforms=("hardware_ngfw", "sase"))
SOME_PLATFORMS = Filters(platforms=("hardware_ngfw", "sase"))
CUSTOMER, PRODUCT = "C2", "P71726adf"
OTHER = "C3"
PLATFORM, MODEL = "sase", "MEDIUM"
#: A floor that some SKUs reach for the first time in the last month.
LATE_VALUE = DEFAULTS.with_values(use_floor=0.5)
COHORTS = {"pilot": 3, "control": 4}
OVERRIDES = [
    Override({"weight_utilization": 0.45, "weight_speed": 0.05}, segment="Enterprise", platform="sase"),
    Override({"weight_utilization": 0.30, "weight_features": 0.30}, segment="Enterprise"),
    Override({"overage_score": 0.6}, platform="hardware_ngfw"),
]

RULES = [
    Rule("weight_utilization", 0.45, "Enterprise", "sase", priority=2),
    Rule("weight_utilization", 0.30, "Enterprise", priority=1),
    Rule("weight_features", 0.30, "Enterprise"),
    Rule("overage_score", 0.6, platform="hardware_ngfw"),
    Rule("overage_score", 0.5, platform="hardware_ngfw", valid_from="2026-01-01"),
    Rule("feature_idle", 0.2, platform="sase", valid_from="2026-01-01", valid_to="2026-05-01"),
    Rule("band_middle", 55.0, "Enterprise", priority=1),
    Rule("band_middle", 45.0, valid_from="2026-06-01"),
]

USAGE = schemas.schema(
    "suppkey:long p_type:string size_class:int " + " ".join(f"{c}_{month:%m}:long" for c in ("lines", "quantity") for month in MONTHS)
)

#: The SKU mart built with the register, as the store names it.
RULED_MART = "mart_customer_sku_month_ruled"


class Workspace:
    """Source tables and marts of one folder; each is written on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.star = Star(spark, folder)
        self.store = Store(spark)

    def source(self, name: str) -> DataFrame:
        table = self.store.table(name, lambda: self.star.table(name, self._usage(name)), schemas.RAW[name])
        if self.store.has(*FROM_USAGE):
            self.store.drop("monthly_usage")  # a helper of the tables above, of no use once they are written
        return table

    def close(self) -> None:
        """Deletes the written tables; the next query writes them anew."""
        self.store.close()

    def _usage(self, name: str) -> DataFrame | None:
        # Contracts and both facts come from the same monthly usage, so the line items are read once.
        if name not in FROM_USAGE:
            return None
        return self.store.table("monthly_usage", self.star.monthly_usage, USAGE)

    @property
    def raw(self) -> dict[str, DataFrame]:
        # The tables are independent jobs; small ones run beside the large ones.
        with ThreadPoolExecutor(len(schemas.RAW)) as pool:
            return dict(zip(schemas.RAW, pool.map(self.source, schemas.RAW), strict=True))

    @property
    def sku(self) -> DataFrame:
        return self._mart("mart_customer_sku_month", lambda: marts.customer_sku_month(self.raw))

    @property
    def feature(self) -> DataFrame:
        return self._mart("mart_customer_feature_month", lambda: marts.customer_feature_month(self.raw))

    @property
    def full(self) -> DataFrame:
        return self._mart(
            "mart_sku_month_full",
            lambda: marts.sku_month_full(self.sku, self.source("customers"), self.source("products")),
        )

    @property
    def calendar(self) -> DataFrame:
        return self.store.table("mart_calendar", lambda: portfolio.calendar(self.full), schemas.CALENDAR)

    @property
    def state(self) -> DataFrame:
        """What the month before the last one carries over."""
        return self.store.table("sku_state", lambda: monthly.state_through(self.raw, MONTH_BEFORE), monthly.STATE)

    @property
    def parameters(self) -> DataFrame:
        """The register resolved for every cell, stored beside the marts built with it."""
        rules = register.rule_table(self.star.spark, RULES)
        return self.store.table("mart_parameters", lambda: register.resolve(rules, register.cells(self.raw)), register.PARAMETERS)

    @property
    def sku_ruled(self) -> DataFrame:
        return self.store.table(
            RULED_MART,
            lambda: marts.customer_sku_month(self.raw, parameters=self.parameters),
            schemas.SKU_MONTH,
            by_month=True,
        )

    @property
    def full_ruled(self) -> DataFrame:
        """The denormalised mart with each row's stored parameters."""
        full = marts.sku_month_full(self.sku_ruled, self.source("customers"), self.source("products"))
        return register.attach(full, self.parameters)

    def stored(self, ruled: bool = False) -> dict[str, list[StructType]]:
        """The schemas of the written files of the source tables and the SKU mart; with ``ruled``, of the mart built with the register."""
        _ = self.raw, self.sku_ruled if ruled else self.sku
        mart = RULED_MART if ruled else quality.MART
        found = self.store.stored([*schemas.RAW, mart])
        return found | {quality.MART: found[mart]}

    def _mart(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        return self.store.table(name, make, schemas.MARTS[name], by_month=True)


_workspaces: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, folder: str) -> Workspace:
    """One workspace per application and folder, so that queries share written tables."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _workspaces:
        _workspaces[key] = Workspace(spark, folder.rstrip("/"))
    return _workspaces[key]


# ---- queries that need a few lines of their own ---------------------------


def _stg_feature(w: Workspace) -> DataFrame:
    return staging.feature_month(w.source("feature_adoption"), w.source("features"))


def _ttv(w: Workspace) -> DataFrame:
    first = marts.first_value_month(staging.sku_month(w.source("consumption")))
    return marts.time_to_value(w.source("entitlements"), first)


def _components(w: Workspace) -> DataFrame:
    rows = components.sku_components(
        staging.sku_month(w.source("consumption")), staging.feature_adoption_avg(_stg_feature(w))
    )
    places = ("lur", "util_health", "feature_adoption", "sustained_usage", "prior_lur")
    return rows.withColumns({c: rnd(F.col(c), 6) for c in places})


def _hash_bucket(w: Workspace) -> DataFrame:
    bucket = keys.portable_bucket(F.concat(F.lit("bucket-"), "entitlement_id"), 16)
    return w.source("entitlements").select("entitlement_id", bucket.alias("bucket"))


def _quota_cohort(w: Workspace) -> DataFrame:
    people = w.source("customers").select("cust_id")
    return keys.quota_cohort(people, "cust_id", COHORTS, rest="everyone else", seed="cohort-")


def _surrogate_key(w: Workspace) -> DataFrame:
    rows = w.source("entitlements").select("entitlement_id", "cust_id", "product_id", "is_expansion")
    order = ["cust_id", "is_expansion", "product_id"]
    return keys.surrogate_key(rows, keys.prepare_keys(rows, order), order, "contract_no", "E%05d")


def _feature_thresholds(w: Workspace) -> DataFrame:
    volume = volumes.expected_volume(w.source("feature_adoption"))
    return volume.select("feature_id", *volumes.feature_thresholds(F.col("expected_active_volume")))


def _contract_union(w: Workspace) -> DataFrame:
    rows = w.source("entitlements").drop("arr", "end_date")
    base, grown = rows.where(~F.col("is_expansion")), rows.where("is_expansion")
    return contracts.contract_union(base.drop("is_expansion"), grown.drop("is_expansion"))


def _contract_terms(w: Workspace) -> DataFrame:
    rows = w.source("entitlements").select("entitlement_id", "units_purchased", "unit_price", "start_date")
    return contracts.contract_terms(rows).select("entitlement_id", "arr", "end_date")


def _month_spine(w: Workspace) -> DataFrame:
    rows = w.source("entitlements").select("entitlement_id", "start_date", "end_date")
    return contracts.month_spine(rows, FIRST_MONTH, LAST_MONTH).select("entitlement_id", "month", "month_idx")


def _active_length(w: Workspace) -> DataFrame:
    pairs = contracts.contract_features(
        w.source("entitlements").select("entitlement_id", "product_id", "start_date", "end_date"), w.source("features")
    )
    spine = contracts.month_spine(pairs, FIRST_MONTH, LAST_MONTH)
    return contracts.active_length(spine).select("entitlement_id", "feature_id", "month", "active_len")


def _contract_features(w: Workspace) -> DataFrame:
    pairs = contracts.contract_features(w.source("entitlements"), w.source("features"))
    return pairs.select("entitlement_id", "product_id", "feature_id")


def _changed(full: DataFrame) -> DataFrame:
    """A copy of the mart in which one customer's last scores are higher and another one lacks a month."""
    higher = (F.col("cust_id") == CUSTOMER) & (F.col("month") == day(AS_OF))
    rows = full.where(~((F.col("cust_id") == OTHER) & (F.col("month") == day(MONTH_BEFORE))))
    return rows.withColumn("vrs", F.when(higher, F.col("vrs") + 1.0).otherwise(F.col("vrs")))


def _restated(w: Workspace) -> DataFrame:
    before = monthly.state_through(w.raw, MONTH_BEFORE, LATE_VALUE)
    return monthly.restated(w.raw, monthly.first_valued(before, w.raw, LAST_MONTH, LATE_VALUE), LAST_MONTH, LATE_VALUE)


def _through_csv(df: DataFrame, name: str) -> DataFrame:
    path = fresh_folder(df.sparkSession, name)
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema)


def _namespace(w: Workspace) -> str:
    """A new namespace of its own folder below the shared one."""
    name = f"uptake_{uuid.uuid4().hex}"
    warehouse.create_namespace(w.star.spark, name, fresh_folder(w.star.spark, "namespace"))
    return name


def _through_catalog(w: Workspace) -> DataFrame:
    """The SKU mart as a catalog table, saved with a wrong last month that is then replaced."""
    name = f"{_namespace(w)}.sku_mart"
    wrong = w.sku.withColumn("vrs", F.when(F.col("month") == day(AS_OF), F.lit(0.0)).otherwise(F.col("vrs")))
    warehouse.save(wrong, name)
    warehouse.replace_months(w.sku, name, [AS_OF])
    return tables.read_table(w.star.spark, name, schemas.SKU_MONTH)


def _stored_view(w: Workspace, view: str, *needed: str) -> DataFrame:
    """A view that the catalog stores, over tables that it stores."""
    namespace = _namespace(w)
    for name in needed:
        warehouse.save(w.source(name), f"{namespace}.{name}")
    warehouse.create_views(w.star.spark, namespace, only=(view,))
    return w.star.spark.table(f"{namespace}.{view}")


def _raw_through_csv(w: Workspace) -> DataFrame:
    """The six source tables written as CSV and read back: rows, and the sum of a hash of each row's first column."""
    folder = fresh_folder(w.star.spark, "raw-csv")
    tables.write_raw_csv(w.raw, folder)
    back = tables.read_raw(w.star.spark, folder, "csv")
    parts = [
        df.agg(F.count("*").alias("rows"), F.sum(keys.portable_hash(F.col(df.columns[0]))).alias("key_sum")).select(F.lit(name).alias("table_name"), "rows", "key_sum")
        for name, df in back.items()
    ]
    return reduce(DataFrame.unionByName, parts)


#: The parameters that ``RULES`` change.
RULED = sorted({r.name for r in RULES})

Query = Callable[[Workspace], DataFrame]

QUERIES: dict[str, Query] = {
    # staging and components
    "stg_sku_month": lambda w: staging.sku_month(w.source("consumption")),
    "stg_feature_month": _stg_feature,
    "feature_adoption_avg": lambda w: staging.feature_adoption_avg(_stg_feature(w)),
    "int_sku_components": _components,
    "ent_start": lambda w: contracts.ent_start(w.source("entitlements")),
    "first_value_month": lambda w: marts.first_value_month(staging.sku_month(w.source("consumption"))),
    "ttv": _ttv,
    # marts, computed from the source tables
    "mart_customer_sku_month": lambda w: marts.customer_sku_month(w.raw),
    "mart_customer_feature_month": lambda w: marts.customer_feature_month(w.raw),
    # the last month from carried state
    "sku_state": lambda w: w.state,
    "sku_state_advanced": lambda w: monthly.advance(w.state, w.raw, LAST_MONTH),
    "mart_month_append": lambda w: monthly.month_rows(w.state, w.raw, LAST_MONTH),
    "mart_month_restated": _restated,
    # roll-ups and denormalised forms, read from the written mart
    "mart_customer_month": lambda w: marts.customer_month(w.sku, w.source("customers")),
    "mart_product_month": lambda w: marts.product_month(w.sku, w.source("products")),
    "mart_sku_month_full": lambda w: marts.sku_month_full(w.sku, w.source("customers"), w.source("products")),
    "mart_feature_full": lambda w: marts.feature_full(w.feature),
    # portfolio
    "months": lambda w: portfolio.months(w.calendar),
    "latest_month": lambda w: portfolio.latest_month(w.calendar),
    "snapshot": lambda w: portfolio.snapshot(w.full, AS_OF),
    "snapshot_filtered": lambda w: portfolio.snapshot(w.full, AS_OF, SOME),
    "portfolio_trend": lambda w: _rounded(portfolio.portfolio_trend(w.full), "vrs"),
    "portfolio_trend_filtered": lambda w: _rounded(portfolio.portfolio_trend(w.full, SOME), "vrs"),
    "risk_trend": lambda w: portfolio.risk_trend(w.full),
    "band_trend": lambda w: portfolio.band_trend(w.full),
    "portfolio_kpis": lambda w: portfolio.portfolio_kpis(w.full, AS_OF),
    "portfolio_kpis_filtered": lambda w: portfolio.portfolio_kpis(w.full, AS_OF, SOME),
    "kpi_movement": lambda w: portfolio.kpi_movement(w.full, known=w.calendar),
    "band_mix": lambda w: portfolio.band_mix(w.full, AS_OF),
    "band_share_history": lambda w: portfolio.band_share_history(w.full),
    "band_share_change_qoq": lambda w: portfolio.band_share_change_qoq(w.full, AS_OF, known=w.calendar),
    "top_movers": lambda w: portfolio.top_movers(w.full, AS_OF, known=w.calendar),
    "state_distribution": lambda w: portfolio.state_distribution(w.full),
    # accounts
    "play_of_customer": lambda w: customers.play_of_customer(w.full, AS_OF),
    "play_catalog": lambda w: customers.play_catalog(w.full, AS_OF),
    "customer_summary": lambda w: customers.customer_summary(w.full, AS_OF),
    "customer_kpis": lambda w: customers.customer_kpis(w.full, AS_OF),
    "play_worklist": lambda w: customers.play_worklist(w.full, AS_OF),
    "play_worklist_activate": lambda w: customers.play_worklist(w.full, AS_OF, "Activate"),
    "customer_products": lambda w: customers.customer_products(w.full, CUSTOMER, AS_OF),
    "customer_products_filtered": lambda w: customers.customer_products(w.full, CUSTOMER, AS_OF, SOME_PLATFORMS),
    "customer_names": lambda w: customers.customer_names(w.full, AS_OF),
    "feature_detail": lambda w: customers.feature_detail(w.feature, CUSTOMER, PRODUCT, AS_OF),
    "sku_series": lambda w: customers.sku_series(w.sku, CUSTOMER, PRODUCT),
    "anomaly_label": lambda w: customers.anomaly_label(w.full, AS_OF),
    # products
    "platform_cards": lambda w: products.platform_cards(w.full, AS_OF),
    "product_model_table": lambda w: products.product_model_table(w.full, AS_OF),
    "model_customers": lambda w: products.model_customers(w.full, PLATFORM, MODEL, AS_OF),
    # assertions
    "source_reconciliation": lambda w: w.star.reconciliation(w.source("consumption"), w.source("feature_adoption")),
    "dq_report": lambda w: quality.report(w.raw, w.sku, stored=w.stored()),
    "dq_gate": lambda w: quality.gate(quality.report(w.raw, w.sku, stored=w.stored())),
    "build_parity": lambda w: quality.build_parity(w.sku, marts.customer_sku_month(w.raw)),
    "export_parity": lambda w: quality.difference_report(w.full, _through_csv(w.full, "sku-full-copy")),
    "changed_export_parity": lambda w: quality.difference_report(w.full, _through_csv(_changed(w.full), "sku-full-changed")),
    "changed_export_keys": lambda w: quality.build_differences(w.full, _through_csv(_changed(w.full), "sku-full-changed")),
    "source_profile": lambda w: quality.source_profile(w.raw),
    "overlap_pairs": lambda w: contracts.overlap_pairs(w.source("entitlements")),
    # exported copies, read back
    "entitlements_csv_roundtrip": lambda w: _through_csv(w.source("entitlements"), "entitlements-csv"),
    "sku_full_csv_roundtrip": lambda w: _through_csv(w.full, "sku-full-csv"),
    "feature_full_csv_roundtrip": lambda w: _through_csv(
        conform(marts.feature_full(w.feature), schemas.FEATURE_FULL), "feature-full-csv"
    ),
    "raw_csv_roundtrip": _raw_through_csv,
    # in a catalog
    "catalog_table_roundtrip": _through_catalog,
    "persisted_sku_view": lambda w: _stored_view(w, "stg_sku_month", "consumption"),
    "persisted_feature_view": lambda w: _stored_view(w, "stg_feature_month", "features", "feature_adoption"),
    # contract and key operators
    "month_spine": _month_spine,
    "hash_bucket": _hash_bucket,
    "quota_cohort": _quota_cohort,
    "surrogate_key": _surrogate_key,
    "feature_thresholds": _feature_thresholds,
    "contract_union": _contract_union,
    "contract_terms": _contract_terms,
    "active_length": _active_length,
    "contract_features": _contract_features,
    "expected_volume": lambda w: volumes.expected_volume(w.source("feature_adoption")),
    # extensions
    "value_realized_share": lambda w: extensions.value_realized_share(w.sku),
    "state_transitions": lambda w: extensions.state_transitions(w.sku),
    "net_transitions": lambda w: extensions.net_transitions(w.sku),
    "first_adopted": lambda w: extensions.first_adopted(w.raw),
    "feature_shelfware": lambda w: extensions.feature_shelfware(w.raw),
    "feature_shelfware_recent": lambda w: extensions.feature_shelfware(w.raw, LAST_MONTH),
    "component_categories": lambda w: extensions.component_categories(w.sku),
    "params_override": lambda w: extensions.params_override(w.raw, OVERRIDES),
    "mart_parameters": lambda w: w.parameters.select(*register.CELL, *[f"param_{n}" for n in RULED]),
    "sku_mart_override": lambda w: marts.customer_sku_month(w.raw, parameters=w.parameters),
    "feature_mart_override": lambda w: marts.customer_feature_month(w.raw, parameters=w.parameters),
    "customer_month_override": lambda w: marts.customer_month(
        w.full_ruled.drop("cust_name", "segment", "region"), w.source("customers"), register.columns()
    ),
    "portfolio_kpis_override": lambda w: portfolio.portfolio_kpis(w.full_ruled, AS_OF, p=register.columns()),
    "band_mix_override": lambda w: portfolio.band_mix(w.full_ruled, AS_OF, p=register.columns()),
    "dq_report_override": lambda w: quality.report(w.raw, w.sku_ruled, stored=w.stored(ruled=True), parameters=w.parameters),
    "dq_report_capped": lambda w: quality.report(
        w.raw, marts.customer_sku_month(w.raw, HARSH_OVERAGE), stored=w.stored(), p=HARSH_OVERAGE
    ),
    "smooth_curve": lambda w: extensions.smooth_curve(w.raw),
    "overage_cap_60": lambda w: extensions.overage_cap_60(w.raw),
    "ttv_first_signal": lambda w: extensions.ttv_first_signal(w.raw),
    "naive_utilization": lambda w: extensions.naive_utilization(w.source("consumption")),
    "peer_percentile": lambda w: extensions.peer_percentile(w.sku),
    "at_risk_share": lambda w: portfolio.at_risk_share(w.full),
}


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: rnd(F.col(n), 6) for n in names})
