"""Readers and writers of the raw tables and the marts.

Schemas are always explicit: nothing is inferred from file contents.
"""

import hashlib
import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce
from io import TextIOWrapper
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs, parquet
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from uptake import schemas
from uptake.functions.calendar import day

# ---- reading ---------------------------------------------------------------


class MissingColumn(ValueError):
    """A table lacks a column that its schema names."""


def _all_there(path: str, stored: list[str], schema: StructType) -> None:
    missing = [name for name in schema.names if name not in stored]
    if missing:
        raise MissingColumn(f"{path} has no column {', '.join(missing)}")


def read_parquet(spark: SparkSession, path: str, schema: StructType, strict: bool = False) -> DataFrame:
    """Parquet by column name. With ``strict`` a column that any file's footer lacks is an error, else it is NULL there."""
    if strict:
        for stored in stored_schemas(spark, path) or [StructType()]:
            _all_there(path, stored.names, schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_csv(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> DataFrame:
    """CSV with a header line, by column name; malformed rows fail the read instead of turning to NULL.

    The first header gives the order of the columns; a file with another order fails the
    read. A column that the header lacks is an error, or NULL if not ``strict``. A bare empty field is NULL, a quoted
    one is the empty text. All columns are parsed, so that no malformed field goes unnoticed.
    """
    wanted = {f.name: StringType() if isinstance(f.dataType, BooleanType) else f.dataType for f in schema}
    header = spark.read.option("header", True).csv(path).columns
    if strict:
        _all_there(path, header, schema)
    rows = (
        spark.read.schema(StructType([StructField(name, wanted.get(name, StringType())) for name in header]))
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("dateFormat", "yyyy-MM-dd")
        .option("nullValue", r"\N")
        .option("mode", "FAILFAST")
        .csv(path)
    )
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in header})
    return repair_booleans(rows, schema).select(*schema.names)


def read_table(spark: SparkSession, name: str, schema: StructType) -> DataFrame:
    """A catalog table, e.g. ``warehouse.consumption``."""
    return spark.table(name).select(*schema.names)


def _raw_path(root: str, name: str, fmt: str) -> str:
    return {"parquet": f"{root}/{name}", "csv": f"{root}/{name}.csv", "table": f"{root}.{name}"}[fmt]


def read_raw(spark: SparkSession, root: str, fmt: str = "parquet", strict: bool = True) -> dict[str, DataFrame]:
    """The six source tables from ``root/<table>`` (parquet) or ``root/<table>.csv``.

    For ``fmt='table'``, ``root`` is a catalog namespace. Columns that are missing from files are an error,
    or NULL if not ``strict``.
    """
    readers: dict[str, Callable[[str, StructType], DataFrame]] = {
        "parquet": lambda path, s: read_parquet(spark, path, s, strict),
        "csv": lambda path, s: read_csv(spark, path, s, strict),
        "table": lambda name, s: read_table(spark, name, s),
    }
    if fmt not in readers:
        raise ValueError(f"unknown format: {fmt}")
    return {name: readers[fmt](_raw_path(root, name, fmt), schema) for name, schema in schemas.RAW.items()}


def _shape(path: str) -> str:
    """The partition folders on the way to a file, each value as a date or by the kinds of its characters."""

    def kind(value: str) -> str:
        try:
            return f"date {len(date.fromisoformat(value).isoformat()) == len(value)}"
        except ValueError:
            return re.sub(r"\d", "9", value)

    folders = [part.partition("=") for part in path.rpartition("/")[0].split("/") if "=" in part]
    return "/".join(f"{name}={kind(value)}" for name, _, value in folders)


def _stored_head(path: str, fmt: str) -> str:
    """What a file says of its columns: the parquet footer's schema, or the CSV header line."""
    store, place = fs.FileSystem.from_uri(path)
    if fmt == "csv":
        with store.open_input_stream(place) as stream:
            return TextIOWrapper(stream, "utf-8", newline="").readline()
    with store.open_input_file(place) as file:
        footer = parquet.read_metadata(file)
    written_by_spark = (footer.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"").decode()
    # The first line of the text names the object, not the schema.
    return str(footer.schema).partition("\n")[2] + written_by_spark


def schema_examples(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet") -> DataFrame:
    """One file's ``path`` for each table and different footer (or header line) below the table's path, and how many ``files`` share it.

    ``paths`` maps tables to folders. Tasks read the footers only, so this is one job at any number of tables and files. A file
    that tasks can't open by themselves, on a store that only Spark knows, is an example of its own.
    """

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files, found = batch.column("path").to_pylist(), []
            for file in files:
                try:
                    found.append(f"{_shape(file)}\n{_stored_head(quote(file, safe=':/='), fmt)}")
                except (OSError, ValueError):
                    found.append(file)
            digests = [hashlib.sha256(text.encode()).hexdigest() for text in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("table"), pa.array(digests, pa.string()), pa.array(files, pa.string())], ["table", "head", "path"]
            )

    listed = [spark.read.format("binaryFile").load(path).select(F.lit(name).alias("table"), "path") for name, path in paths.items()]
    found = reduce(DataFrame.union, listed).mapInArrow(heads, "table string, head string, path string")
    return found.groupBy("table", "head").agg(F.min("path").alias("path"), F.count("*").alias("files"))


def stored_schemas_of(
    spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", expected: dict[str, StructType] | None = None
) -> dict[str, list[StructType]]:
    """Each table's different schemas, of the files below its path or of the catalog table ``path``.

    Every file's footer (or header line) is read, since one file's schema says nothing of the others; Spark then gives the schema of
    one file for each different footer. Partition columns count as stored. CSV stores names only, so its types are those of ``expected``.
    """
    if fmt == "table":
        return {name: [spark.table(path).schema] for name, path in paths.items()}
    types = {name: {f.name: f.dataType for f in (expected or {}).get(name, [])} for name in paths}

    def schema_of(example: Row) -> StructType:
        if fmt == "parquet":
            return spark.read.option("basePath", paths[example.table]).parquet(example.path).schema
        names = spark.read.option("header", True).csv(example.path).columns
        return StructType([StructField(name, types[example.table].get(name, StringType())) for name in names])

    examples = sorted(schema_examples(spark, paths, fmt).collect(), key=lambda row: row.path)
    found: dict[str, list[StructType]] = {name: [] for name in paths}
    with ThreadPoolExecutor(16) as pool:
        for example, schema in zip(examples, pool.map(schema_of, examples), strict=True):
            found[example.table].append(schema)
    return found


def stored_schemas(spark: SparkSession, path: str, fmt: str = "parquet", expected: StructType | None = None) -> list[StructType]:
    """The different schemas of one table's files, as in ``stored_schemas_of``."""
    return stored_schemas_of(spark, {path: path}, fmt, {path: expected} if expected else None)[path]


def stored_raw(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, list[StructType]]:
    """The stored schemas of the six source tables, for the schema assertions."""
    return stored_schemas_of(spark, {name: _raw_path(root, name, fmt) for name in schemas.RAW}, fmt, schemas.RAW)


def repair_booleans(df: DataFrame, schema: StructType) -> DataFrame:
    """Casts columns that should be boolean but arrived as text ('true', 'False')."""
    wanted = [f.name for f in schema if isinstance(f.dataType, BooleanType) and f.name in df.columns]
    return df.withColumns({name: F.col(name).cast("boolean") for name in wanted})


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Columns in the order and with the types of ``schema``."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


# ---- writing ---------------------------------------------------------------


def write_by_month(df: DataFrame, path: str, months: list[str] | None = None) -> None:
    """Parquet partitioned by month.

    ``rebalance`` lets AQE gather each month's rows into files of the advisory
    size and split months that are larger, so a month is neither one task nor
    one small file per task. With ``months``, only those partitions are replaced; one
    that has no rows any more is left empty. Rows are sorted within files, so that a
    look-up of one customer or product skips most row groups.
    """
    writer, seen = df, Observation()
    keys = [name for name in ("month", "cust_id", "product_id") if name in df.columns]
    if months is not None:
        writer = writer.where(F.col("month").isin(*[day(m) for m in months]))
        writer = writer.observe(seen, F.collect_set(F.col("month").cast("string")).alias("months"))
    (
        writer.hint("rebalance", "month")
        .sortWithinPartitions(*keys)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if months is None else "dynamic")
        .partitionBy("month")
        .parquet(path)
    )
    for month in sorted(set(months or ()) - set(seen.get["months"] if months else ())):
        nothing = df.sparkSession.createDataFrame([], df.drop("month").schema)
        nothing.write.mode("overwrite").parquet(f"{path}/month={month}")


def write_table(df: DataFrame, path: str) -> None:
    """Plain parquet, one file per task; AQE has already sized the tasks."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV files with a header, one per task."""
    df.write.mode("overwrite").option("header", True).option("dateFormat", "yyyy-MM-dd").csv(path)


def write_raw_csv(raw: dict[str, DataFrame], root: str) -> None:
    for name, schema in schemas.RAW.items():
        write_csv(conform(raw[name], schema), f"{root}/{name}.csv")


def register_views(frames: dict[str, DataFrame]) -> None:
    """Temporary views for SQL users; nothing is computed."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)

