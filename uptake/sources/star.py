"""The six source tables, derived from a sales star schema.

Suppliers become customers, part types become products, part sizes become
features, and shipped quantities folded onto one calendar year become usage. A contract
exists for each supplier and part type that the line items show, from the first month with one, so
every line item is usage of some contract; ``reconciliation`` compares the sums. Licence
sizes by supplier, not cuts of the usage, bring about the states of the marts.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake.functions.calendar import day
from uptake.operators.contracts import contract_terms, contract_union, month_spine
from uptake.schemas import RAW
from uptake.sources.tables import conform
from uptake.vocabulary import PLATFORM_UNITS

FIRST_MONTH = "2025-07-01"
LAST_MONTH = "2026-06-01"
EXPANSION_START = "2026-01-01"
FEATURE_FLOOR = 3
FEATURE_DEEP = 6
#: The months of the calendar year onto which ship dates are folded, in order.
MONTHS = [date(2025 + (6 + i) // 12, (6 + i) % 12 + 1, 1) for i in range(12)]
#: Tables that are made from the monthly usage.
FROM_USAGE = ("entitlements", "consumption", "feature_adoption")

# group (supplier key modulo 20) -> behaviour label
PROFILES = {
    0: "shelfware",
    1: "shelfware",
    2: "overage",
    3: "overage",
    4: "overage",
    5: "spike_drop",
    6: "slow_onboarder",
    7: "intermittent",
}


class Star:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- usage facts ---------------------------------------------------

    def monthly_usage(self) -> DataFrame:
        """One row for each supplier, part type and size class, with the number of lines and the quantity in hundredths of each month.

        Line items are dealt by cell and fold there at once to the year's twelve columns: before the exchange hardly two of a task's
        lines share a cell and month, so a fold there costs more than it saves. A task streams its lines and holds cells, so a supplier
        with very many lines is spread over its cells and fills no memory. Lines without a ship date show that
        a cell exists and count in no month. What reads this table needs neither a join by month nor a second fold of the months.
        """
        moy = F.month("l_shipdate")
        line = self.read("lineitem").select("l_suppkey", "l_partkey", "l_quantity", moy.alias("moy"))
        part = self.read("part").select("p_partkey", "p_type", _size_class().alias("size_class"))
        cell = ["suppkey", "p_type", "size_class"]
        sold = line.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
            F.col("l_suppkey").alias("suppkey"), "p_type", "size_class", "moy", _hundredths(F.col("l_quantity")).alias("quantity"), F.lit(1).cast("long").alias("lines")
        )
        here = {month: F.col("moy") == month.month for month in MONTHS}
        sums = {f"{c}_{month:%m}": F.sum(F.when(here[month], F.col(c))) for c in ("lines", "quantity") for month in MONTHS}
        return sold.repartition(*cell).groupBy(*cell).agg(*[v.alias(n) for n, v in sums.items()])

    # ---- dimensions ----------------------------------------------------

    def customers(self) -> DataFrame:
        label = F.coalesce(*[F.when(_group() == g, name) for g, name in PROFILES.items()], F.lit("normal"))
        return (
            self.read("supplier")
            .join(self.read("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                _customer_id().alias("cust_id"),
                F.col("s_name").alias("cust_name"),
                F.col("r_name").alias("region"),
                F.when(F.col("s_acctbal") >= 4500, "Enterprise").otherwise("Mid-Market").alias("segment"),
                label.alias("behavior_profile"),
            )
        )

    def products(self) -> DataFrame:
        codes = F.array(*[F.lit(code) for code in PLATFORM_UNITS])
        units = F.array(*[F.lit(unit) for unit in PLATFORM_UNITS.values()])
        slot = (_type_number() % len(PLATFORM_UNITS)).cast("int")
        types = self.read("part").select("p_type").distinct()
        return types.select(
            _product_id().alias("product_id"),
            F.format_string("%s SKU-%04d", "p_type", _type_number() % 10000).alias("product_name"),
            codes[slot].alias("product_platform"),
            units[slot].alias("unit_of_measure"),
        )

    def features(self) -> DataFrame:
        sizes = self.read("part").select("p_type", _size_class().alias("size_class")).distinct()
        name = F.concat(F.lit("Size class "), F.col("size_class").cast("string"))
        return sizes.select(
            _feature_id().alias("feature_id"),
            name.alias("feature_name"),
            F.concat(name, F.lit(" of "), F.col("p_type")).alias("feature_description"),
            _product_id().alias("product_id"),
            F.lit(FEATURE_FLOOR).alias("meaningful_floor_events"),
            F.lit(FEATURE_DEEP).alias("deep_threshold_events"),
        )

    # ---- contracts -----------------------------------------------------

    def _contracts(self, usage: DataFrame) -> DataFrame:
        """One contract per observed supplier and part type, plus a mid-year expansion for some suppliers."""
        key, number, group = F.col("s_suppkey"), _type_number(), _group()
        licence = (
            F.when(group.isin(0, 1), 100_000)
            .when(group.isin(2, 3, 4), 40)
            .when(group == 6, 2500)
            .when(group == 7, 600)
            .otherwise(150 + 50 * ((key + number) % 4))
        )
        seen = F.least(*[F.when(F.col(f"lines_{month:%m}") > 0, F.lit(month)) for month in MONTHS])
        observed = usage.groupBy(F.col("suppkey").alias("s_suppkey"), "p_type").agg(F.min(seen).alias("start_date"))
        signed = observed.withColumn("units_purchased", licence.cast("long"))
        more = F.when(group == 5, 20_000).otherwise(400).cast("long")
        grown = observed.where(_grows()).withColumns({"units_purchased": more, "start_date": day(EXPANSION_START)})
        return contract_terms(
            contract_union(signed, grown).withColumns(
                {
                    "unit_price": (10 + 5 * (number % 6)).cast("double"),
                    "licensed_amount": F.col("units_purchased"),
                    "product_id": _product_id(),
                    "cust_id": _customer_id(),
                    "entitlement_id": F.concat(
                        F.lit("E"), key.cast("string"), F.lit("-"), _type_code(), F.when(F.col("is_expansion"), "x").otherwise("")
                    ),
                }
            )
        )

    def entitlements(self, usage: DataFrame) -> DataFrame:
        return self._contracts(usage)

    # ---- facts ---------------------------------------------------------

    def consumption(self, usage: DataFrame) -> DataFrame:
        """Each contract's months; while a supplier has an expansion, half of the usage is the expansion's."""
        sums = [F.sum(F.col(f"quantity_{month:%m}")) for month in MONTHS]
        shipped = usage.groupBy(F.col("suppkey").alias("s_suppkey"), "p_type").agg(F.array(*sums).alias("shipped"))
        spine = _spine(self._contracts(usage).join(shipped, ["s_suppkey", "p_type"], "left"))
        part = F.when(_shared(), 0.5).otherwise(1.0)
        return spine.select(
            F.concat_ws("-", F.lit("U"), "entitlement_id", _compact(F.col("month"))).alias("consumption_id"),
            "entitlement_id",
            "cust_id",
            "product_id",
            "month",
            (F.coalesce(_of_month("shipped") / 100, F.lit(0.0)) * part).alias("consumed_units"),
            "licensed_amount",
        )

    def feature_adoption(self, usage: DataFrame) -> DataFrame:
        """Each contract's months for every size class it was seen with; usage of parts without a size is no feature's."""
        counts = [F.when(F.col("size_class").isNotNull(), F.col(f"lines_{month:%m}")) for month in MONTHS]
        seen = usage.select(F.col("suppkey").alias("s_suppkey"), "p_type", "size_class", F.array(*counts).alias("counts"))
        entitled = self._contracts(usage).join(seen, ["s_suppkey", "p_type"]).select(
            "*", _feature_id().alias("feature_id"), F.concat_ws("-", F.lit("A"), "entitlement_id", "size_class").alias("series")
        )
        lines = F.coalesce(_of_month("counts"), F.lit(0).cast("long"))
        half = F.floor(lines / 2)
        events = F.when(_shared(), F.when(F.col("is_expansion"), half).otherwise(lines - half)).otherwise(lines)
        return _spine(entitled).select(
            F.concat_ws("-", "series", _compact(F.col("month"))).alias("adoption_id"),
            "cust_id",
            "entitlement_id",
            "product_id",
            "feature_id",
            "month",
            events.alias("usage_events"),
        )

    def table(self, name: str, usage: DataFrame | None = None) -> DataFrame:
        """One of the six source tables; those of ``FROM_USAGE`` take the monthly usage, if at hand."""
        if name in FROM_USAGE:
            df = getattr(self, name)(self.monthly_usage() if usage is None else usage)
        else:
            df = getattr(self, name)()
        return conform(df, RAW[name])

    def reconciliation(self, consumption: DataFrame, feature_adoption: DataFrame) -> DataFrame:
        """``measure, given, derived``: quantity and number of the line items against the sums of the two facts."""
        items = self.read("lineitem").agg(F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("units"), F.count("*").alias("events"))
        used = consumption.agg(F.sum(F.col("consumed_units").cast("decimal(18,2)")).alias("units"))
        done = feature_adoption.agg(F.sum("usage_events").alias("events"))

        def rows(df: DataFrame, side: str, names: tuple[str, ...]) -> DataFrame:
            other = "derived" if side == "given" else "given"
            values = [F.struct(F.lit(n).alias("measure"), F.col(n).cast("double").alias(side)) for n in names]
            return df.select(F.inline(F.array(*values))).withColumn(other, F.lit(None).cast("double"))

        sides = [rows(items, "given", ("units", "events")), rows(used, "derived", ("units",)), rows(done, "derived", ("events",))]
        return reduce(DataFrame.unionByName, sides).groupBy("measure").agg(F.max("given").alias("given"), F.max("derived").alias("derived"))


def _spine(contracts: DataFrame) -> DataFrame:
    return month_spine(contracts, FIRST_MONTH, LAST_MONTH)


def _of_month(values: str) -> Column:
    """The element that stands for the row's month."""
    since = (F.year("month") - MONTHS[0].year) * 12 + F.month("month") - MONTHS[0].month
    return F.element_at(values, since + 1)


def _compact(month: Column) -> Column:
    """Year and month as six digits."""
    return (F.year(month) * 100 + F.month(month)).cast("string")


def _group() -> Column:
    return F.col("s_suppkey") % 20


def _size_class() -> Column:
    return F.expr("cast((p_size - 1) div 13 as int)")


def _hundredths(quantity: Column) -> Column:
    """A quantity in hundredths, rounded half up; whole ones need no decimal, which is slow to make of a double."""
    whole = (quantity == F.floor(quantity)) & (F.abs(quantity) < 1e9)
    return F.when(whole, quantity.cast("long") * 100).otherwise((quantity.cast("decimal(12,2)") * 100).cast("long"))


def _customer_id() -> Column:
    return F.concat(F.lit("C"), F.col("s_suppkey").cast("string"))


def _type_code() -> Column:
    """Eight hexadecimal digits that stand for a part type, found without a list of all types."""
    return F.substring(F.md5("p_type"), 1, 8)


def _type_number() -> Column:
    return F.conv(_type_code(), 16, 10).cast("long")


def _grows() -> Column:
    return (F.col("s_suppkey") % 17 == 7) | (_group() == 5)


def _shared() -> Column:
    return _grows() & (F.col("month") >= day(EXPANSION_START))


def _product_id() -> Column:
    return F.concat(F.lit("P"), _type_code())


def _feature_id() -> Column:
    return F.concat(F.lit("F"), _type_code(), F.lit("-"), F.col("size_class").cast("string"))
