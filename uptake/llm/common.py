"""Small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from uptake.sources.shared import fresh_folder

#: Bytes of text that one step inside a task works on at once.
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    The copy cuts the lineage, survives lost executors and has a known size.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_order(name: str = "doc_id") -> Column:
    """The id as a long that is never null: null ids come before all others."""
    return F.coalesce(F.col(name).cast("long"), F.lit(-(2**63)))


def numbered(docs: DataFrame) -> DataFrame:
    """``whole`` (each row of ``docs`` as one struct, so that no helper column can clash with its own) and ``uid``, written once."""
    return written(docs.select(F.struct(*docs.columns).alias("whole"), F.monotonically_increasing_id().alias("uid")), "numbered")


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with as many underscores in front as it takes to differ from all columns."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each; a longer text comes alone."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        start = held = 0
        for k, n in enumerate(sizes.tolist()):
            if k > start and held + n > limit:
                yield batch.slice(start, k - start)
                start, held = k, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def prefix_sums(df: DataFrame, by: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one, within ``by`` and along ``order``.

    The rows are range-sorted by group and order, so a hot group spans many
    partitions. Each partition sums its own rows; the offsets come from one sum for each
    group and partition. ``df`` should be narrow: it is written once.
    """
    spark = df.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(c).asc_nulls_last() for c in [*by, *order]]
    ranged = written(df.repartitionByRange(parts, *keys).withColumn("_part", F.spark_partition_id()), "ranges")
    sums = ranged.groupBy(*by, "_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(c).alias(f"_{c}") for c in by],
        F.col("_part").alias("_at"),
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"),
    )
    same = F.col("_part") == F.col("_at")
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = Window.partitionBy(*by, "_part").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    inside = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn("_inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .join(offsets, same)
        .withColumn(out, F.col("_offset") + F.col("_inside"))
        .drop("_inside", "_offset", "_at", "_part", *[f"_{c}" for c in by])
    )
