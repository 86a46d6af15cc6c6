"""The parameter register as a table: rules by segment, platform and month, resolved and stored beside the mart.

A rule gives one parameter a value for a segment or for all, for a platform or for all, from a month on and until another.
Of the rules that reach a cell (segment, platform, month) the highest priority wins, among those the latest
``valid_from``, then the larger value; without a rule the default holds. Resolving joins each cell's four scopes
with the rules by equality and takes the best one in an aggregate. The resolved table has one row a cell, whatever the
number of contracts, and is what scoring, bands and assertions read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from uptake import schemas
from uptake.params import DEFAULTS, ScoreParams

NAMES = [f.name for f in fields(ScoreParams)]
RULES = schemas.schema("name:string value:double segment:string platform:string priority:int valid_from:date valid_to:date")
CELL = ["segment", "product_platform", "month"]
PARAMETERS = schemas.schema("segment:string product_platform:string month:date " + " ".join(f"param_{n}:double" for n in NAMES))


@dataclass(frozen=True)
class Rule:
    """``valid_from`` is included, ``valid_to`` is not; None means all segments, all platforms, no limit."""

    name: str
    value: float
    segment: str | None = None
    platform: str | None = None
    priority: int = 0
    valid_from: str | None = None
    valid_to: str | None = None


def rule_table(spark: SparkSession, rules: list[Rule]) -> DataFrame:
    text = replace_types(RULES, date="string")
    rows = [(r.name, float(r.value), r.segment, r.platform, r.priority, r.valid_from, r.valid_to) for r in rules]
    return _typed(spark.createDataFrame(rows, text))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules from JSON lines with the fields of ``Rule``."""
    return _typed(spark.read.schema(replace_types(RULES, date="string")).option("mode", "FAILFAST").json(path))


def replace_types(schema, **kinds: str):
    """A copy of a schema in which each named type becomes another one."""
    spec = [f"{f.name}:{kinds.get(f.dataType.simpleString(), f.dataType.simpleString())}" for f in schema]
    return schemas.schema(" ".join(s.replace("bigint", "long") for s in spec))


def _typed(rules: DataFrame) -> DataFrame:
    return rules.select(
        *[(F.to_date(F.col(f.name)) if f.name.startswith("valid") else F.col(f.name)).alias(f.name) for f in RULES]
    ).withColumn("priority", F.coalesce("priority", F.lit(0)))


def unknown_names(rules: DataFrame) -> list[str]:
    """Names that are no parameters, ten at most."""
    odd = rules.where(F.col("name").isNull() | ~F.col("name").isin(NAMES)).select("name").distinct()
    return [str(r.name) for r in odd.orderBy("name").limit(10).collect()]


def sku_traits(raw: Mapping[str, DataFrame]) -> DataFrame:
    """``cust_id, product_id, segment, product_platform`` of every SKU with a contract."""
    skus = raw["entitlements"].select("cust_id", "product_id").distinct()
    people, things = raw["customers"].select("cust_id", "segment"), raw["products"].select("product_id", "product_platform")
    return skus.join(people, "cust_id", "left").join(things, "product_id", "left")


def cells(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Every segment and platform that contracts combine, in every month from the first to the last one of use."""
    span = raw["consumption"].agg(F.min("month").alias("first"), F.max("month").alias("last"))
    pairs = sku_traits(raw).select(*CELL[:2]).distinct()
    month = F.explode(F.sequence(span.select("first").scalar(), span.select("last").scalar(), F.expr("interval 1 month")))
    return pairs.withColumn("month", month)


def resolve(rules: DataFrame, within: DataFrame, base: ScoreParams = DEFAULTS) -> DataFrame:
    """One row for each cell of ``within`` with the value of every parameter as ``param_<name>``."""
    odd = unknown_names(rules)
    if odd:
        raise ValueError(f"unknown parameter: {', '.join(odd)}")
    none = F.lit(None).cast("string")
    own, of_platform = F.col("segment"), F.col("product_platform")
    scopes = [F.struct(s.alias("in_segment"), p.alias("in_platform")) for s in (own, none) for p in (of_platform, none)]
    asked = within.select(*CELL, F.explode(F.array(*scopes)).alias("scope")).select(*CELL, "scope.*").distinct()
    scoped = rules.select("name", "value", F.col("segment").alias("for_segment"), F.col("platform").alias("for_platform"),
                          "priority", "valid_from", "valid_to")
    same = F.col("in_segment").eqNullSafe(F.col("for_segment")) & F.col("in_platform").eqNullSafe(F.col("for_platform"))
    started = F.col("valid_from").isNull() | (F.col("valid_from") <= F.col("month"))
    running = F.col("valid_to").isNull() | (F.col("month") < F.col("valid_to"))
    reached = asked.join(scoped, same & started & running, "left")
    rank = F.struct("priority", F.coalesce("valid_from", F.lit("0001-01-01").cast("date")), "value")
    best = [F.max_by("value", F.when(F.col("name") == n, rank)).alias(n) for n in NAMES]
    found = reached.groupBy(*CELL).agg(*best)
    return found.select(*CELL, *[F.coalesce(n, F.lit(float(getattr(base, n)))).alias(f"param_{n}") for n in NAMES])


def columns() -> ScoreParams:
    """Parameters that read the columns ``attach`` adds."""
    return replace(DEFAULTS, **{n: F.col(f"param_{n}") for n in NAMES})


def attach(rows: DataFrame, parameters: DataFrame, base: ScoreParams = DEFAULTS) -> DataFrame:
    """``rows`` (with ``segment, product_platform, month``) and their cell's parameters; the defaults where there is no cell."""
    known = parameters.select(*[F.col(c).alias(f"cell_{c}") for c in CELL], *[f"param_{n}" for n in NAMES])
    same = F.lit(True)
    for c in CELL:
        same &= F.col(c).eqNullSafe(F.col(f"cell_{c}"))
    joined = rows.join(known, same, "left").drop(*[f"cell_{c}" for c in CELL])
    return joined.withColumns({f"param_{n}": F.coalesce(f"param_{n}", F.lit(float(getattr(base, n)))) for n in NAMES})


def detach(rows: DataFrame) -> DataFrame:
    return rows.drop(*[f"param_{n}" for n in NAMES])
