"""Jobs for spark-submit.

    spark-submit --py-files uptake.zip uptake/jobs.py build SOURCE TARGET [--format csv] [--months M ...] [--export DIR] [--params FILE]
    spark-submit --py-files uptake.zip uptake/jobs.py append SOURCE TARGET --month M [--format csv]
    spark-submit --py-files uptake.zip uptake/jobs.py check SOURCE TARGET [--format csv] [--expect FILE] [--against DIR]
    spark-submit --py-files uptake.zip uptake/jobs.py publish TARGET NAMESPACE [--months M ...] [--folder DIR]

The same works as ``python -m uptake.jobs``.

``publish`` copies the marts below TARGET into a catalog namespace, whose tables lie below the DIR of ``--folder`` if it is new;
with ``--months`` only those months of its tables are replaced.

``build`` writes every mart below TARGET, one folder each. ``check`` runs the
assertions on SOURCE and TARGET and exits with 1 when one fails; the comparison
with an exported copy only warns. The FILE of ``--expect`` is JSON with fields of ``Expectations``, that of
``--params`` is JSON lines with the fields of ``register.Rule``; ``check`` reads the resolved register from TARGET.
"""

import argparse
import datetime as dt
import json
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from uptake import register, schemas
from uptake.params import DEFAULTS, ScoreParams
from uptake.plans import marts, monthly, portfolio, quality
from uptake.sources import shared, tables, warehouse

EXPORTS = ("mart_sku_month_full", "mart_feature_full")
PARAMETERS = "mart_parameters"
#: So many keys that differ from an exported copy are printed.
NAMED = 50


def mart(spark: SparkSession, target: str, name: str) -> DataFrame:
    return tables.read_parquet(spark, f"{target}/{name}", schemas.MARTS[name])


def build(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    target: str,
    months: list[str] | None = None,
    p: ScoreParams = DEFAULTS,
    rules: DataFrame | None = None,
) -> None:
    """Writes the marts; roll-ups and denormalised forms read the written SKU mart.

    ``rules`` is a parameter register. It is resolved once and stored as ``mart_parameters``, from where the marts,
    their roll-ups and later checks read it.

    With ``months`` only those partitions are replaced, also by nothing. Histories
    are always read in full, since a row depends on the rows before it.
    """

    def write(name: str, df: DataFrame) -> DataFrame:
        tables.write_by_month(tables.conform(df, schemas.MARTS[name]), f"{target}/{name}", months)
        return mart(spark, target, name)

    kept = None
    if rules is not None:
        resolved = register.resolve(rules, register.cells(raw), p)
        tables.write_table(tables.conform(resolved, register.PARAMETERS), f"{target}/{PARAMETERS}")
        kept = tables.read_parquet(spark, f"{target}/{PARAMETERS}", register.PARAMETERS)
    sku = write("mart_customer_sku_month", marts.customer_sku_month(raw, p, parameters=kept))
    feature = write("mart_customer_feature_month", marts.customer_feature_month(raw, p, kept))
    full = write("mart_sku_month_full", marts.sku_month_full(sku, raw["customers"], raw["products"]))
    rolled = sku
    if kept is not None:
        rolled, p = register.attach(full, kept).drop("cust_name", "segment", "region", "product_name", "product_platform"), register.columns()
    write("mart_customer_month", marts.customer_month(rolled, raw["customers"], p))
    write("mart_product_month", marts.product_month(rolled, raw["products"], p))
    tables.write_table(tables.conform(portfolio.calendar(full), schemas.CALENDAR), f"{target}/mart_calendar")
    write("mart_feature_full", marts.feature_full(feature))


def append(spark: SparkSession, raw: dict[str, DataFrame], target: str, month: str, p: ScoreParams = DEFAULTS) -> None:
    """Adds ``month`` to a built SKU mart from the state the month before left, and stores the state after it.

    Facts are read for that month alone. Where a SKU's first value falls into the month, its earlier rows
    are replaced by restated ones. Appending a month again, after a correction, gives the same as a full build up to
    it; the months after it have to follow. Roll-ups are not touched.
    """
    before = _state_before(spark, raw, target, month, p)
    name = "mart_customer_sku_month"
    schema = schemas.MARTS[name]
    fresh = tables.conform(monthly.month_rows(before, raw, month, p), schema)
    tables.write_by_month(fresh, f"{target}/{name}", [month])
    tables.write_table(tables.conform(monthly.advance(before, raw, month, p), monthly.STATE), _state_path(target, month))
    again = monthly.first_valued(before, raw, month, p)
    changed = tables.conform(monthly.restated(raw, again, month, p), schema)
    months = [str(r.month) for r in changed.select("month").distinct().collect()]
    if months:
        old = mart(spark, target, name).where(F.col("month").isin([dt.date.fromisoformat(m) for m in months]))
        kept = old.join(again, ["cust_id", "product_id"], "left_anti")
        staged = f"{target}/restated/{month}"
        tables.write_table(tables.conform(kept.unionByName(changed), schema), staged)
        tables.write_by_month(tables.read_parquet(spark, staged, schema), f"{target}/{name}", months)


def _state_path(target: str, month: str) -> str:
    return f"{target}/sku_state/{month}"


def _state_before(spark: SparkSession, raw: dict[str, DataFrame], target: str, month: str, p: ScoreParams) -> DataFrame:
    """The stored state of the calendar month before ``month``; made from history, once, where none is stored."""
    earlier = str((dt.date.fromisoformat(month).replace(day=1) - dt.timedelta(days=1)).replace(day=1))
    path = _state_path(target, earlier)
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        tables.write_table(tables.conform(monthly.state_through(raw, earlier, p), monthly.STATE), path)
    return tables.read_parquet(spark, path, monthly.STATE)


def export(spark: SparkSession, target: str, folder: str) -> None:
    """CSV copies of the two denormalised marts."""
    for name in EXPORTS:
        tables.write_csv(mart(spark, target, name), f"{folder}/{name}")


def publish(spark: SparkSession, target: str, namespace: str, months: list[str] | None = None, folder: str | None = None) -> None:
    """The marts below ``target`` as tables of a catalog namespace; with ``months``, those months of tables that are there."""
    warehouse.create_namespace(spark, namespace, folder)
    for name in schemas.MARTS:
        table = f"{namespace}.{name}"
        if months is None or not spark.catalog.tableExists(table):
            warehouse.save(mart(spark, target, name), table)
        else:
            warehouse.replace_months(mart(spark, target, name), table, months)


def stored_parameters(spark: SparkSession, target: str) -> DataFrame | None:
    """The resolved register a target was built with, if it was built with one."""
    try:
        found = spark.read.parquet(f"{target}/{PARAMETERS}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.select(*register.PARAMETERS.names)


def check(
    spark: SparkSession,
    raw: dict[str, DataFrame],
    target: str,
    expect: quality.Expectations = quality.Expectations(),
    against: str | None = None,
    stored: dict[str, list[StructType]] | None = None,
) -> int:
    """Prints the report, and the comparison with an export if given; 0 when all pass.

    ``stored`` has the schemas of the source tables' files; those of ``raw`` are judged without it.
    """
    sku = mart(spark, target, quality.MART)
    known = dict(stored or {name: [df.schema] for name, df in raw.items()})
    known[quality.MART] = tables.stored_schemas(spark, f"{target}/{quality.MART}")
    results = quality.report(raw, sku, expect, known, parameters=stored_parameters(spark, target)).collect()  # 36 rows
    for r in results:
        print(f"{r['result']}  {r['cat']:<12} {r['test']:<42} {r['val']:>10} {r['expect']:>10}")
    failed = sum(r["result"] != "PASS" for r in results)
    print(f"{len(results) - failed}/{len(results)} passed")
    if against is not None:
        copy = tables.read_csv(spark, f"{against}/{EXPORTS[0]}", schemas.MARTS[EXPORTS[0]])
        for r in quality.build_parity(sku, copy).collect():  # 3 rows
            print(f"{r['verdict']:<8} {r['check']}: {r['left_value']:,.1f} / {r['right_value']:,.1f}")
        full = mart(spark, target, EXPORTS[0])
        for r in quality.build_differences(full, copy).orderBy("cust_id", "product_id", "month").limit(NAMED).collect():
            print(f"WARNING  {r['kind']}: {r['cust_id']} {r['product_id']} {r['month']}")
    return 1 if failed else 0


def _arguments(argv: list[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="uptake.jobs")
    jobs = parser.add_subparsers(dest="job", required=True)
    job = jobs.add_parser("publish")
    job.add_argument("target")
    job.add_argument("namespace")
    job.add_argument("--months", nargs="+")
    job.add_argument("--folder")
    for name in ("build", "append", "check"):
        job = jobs.add_parser(name)
        job.add_argument("source")
        job.add_argument("target")
        job.add_argument("--format", default="parquet", choices=("parquet", "csv", "table"))
        if name == "build":
            job.add_argument("--months", nargs="+")
            job.add_argument("--export")
            job.add_argument("--params")
        elif name == "append":
            job.add_argument("--month", required=True)
        else:
            job.add_argument("--expect")
            job.add_argument("--against")
    return parser.parse_args(argv)


def main(argv: list[str]) -> int:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"uptake {args.job}").getOrCreate()
    with shared.scratch(spark):  # what the job wrote for itself goes, its results lie in the folders it was given
        return run(spark, args)


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    if args.job == "publish":
        publish(spark, args.target, args.namespace, args.months, args.folder)
        return 0
    # A missing column ends a build; the check goes on and reports it.
    raw = tables.read_raw(spark, args.source, args.format, strict=args.job != "check")
    if args.job == "build":
        rules = register.read_rules(spark, args.params) if args.params else None
        build(spark, raw, args.target, args.months, rules=rules)
        if args.export:
            export(spark, args.target, args.export)
        return 0
    if args.job == "append":
        append(spark, raw, args.target, args.month)
        return 0
    expect = quality.Expectations()
    if args.expect:
        text = "\n".join(r.value for r in spark.read.text(args.expect, wholetext=True).collect())
        expect = quality.Expectations(**json.loads(text))
    return check(spark, raw, args.target, expect, args.against, tables.stored_raw(spark, args.source, args.format))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
