"""Stable buckets, dense ids and exact-size cohorts."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from uptake.sources.shared import fresh_folder

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def hash_bucket(seed: Column, n: int) -> Column:
    """Bucket 0..n-1 of a key, stable across runs and sessions."""
    return F.pmod(F.xxhash64(seed), F.lit(n)).cast("int")


def portable_hash(seed: Column) -> Column:
    """32-bit hash that any engine with md5 can repeat."""
    return F.conv(F.substring(F.md5(seed.cast("string")), 1, 8), 16, 10).cast("long")


def portable_bucket(seed: Column, n: int) -> Column:
    return F.pmod(portable_hash(seed), F.lit(n)).cast("int")


def positions(rows: DataFrame, keys: list[str | Column], tasks: int) -> DataFrame:
    """Rows sorted by range, with partition number and position packed into ``_at``."""
    return (
        rows.repartitionByRange(tasks, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
    )


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def dense_rank_rows(df: DataFrame, order: list[str | Column], name: str, partitions: int | None = None) -> DataFrame:
    """Adds 1..n in the order of ``order``, without a single-task window.

    Ties are broken by the remaining columns, copies of a row by a stored row
    number. The sort key is therefore unique: a large group of ties or copies
    spreads over partitions, and a task that is run again after a lost executor
    repeats its part exactly. The numbered rows are written before the sort and
    the sorted rows after it, because range bounds are sampled and must not be
    drawn twice; what is joined back are one row count per partition.
    """
    tasks = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    named = {o for o in order if isinstance(o, str)}
    others = [f.name for f in df.schema if isinstance(f.dataType, AtomicType) and f.name not in named]
    rows = _stored(df.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    placed = _stored(positions(rows, [*order, *others, "_row"], tasks).drop("_row"), "ranked")
    placed = placed.withColumn("_part", F.shiftrightunsigned("_at", _ROW_BITS))
    sizes = placed.groupBy("_part").count()
    # One row per partition of the shuffle above, so this window is small.
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(running), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_before") + within + 1)
        .drop("_part", "_at", "_before")
    )


def prepare_keys(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """The explicit first step of ``surrogate_key``: the columns of ``order`` alone, sorted by range and written.

    Keys are folded before the sort, so that a repeated key is one row with its count and no hot key fills a range. Nothing but
    ``order``, the count and the place is written.
    """
    tasks = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    folded = df.groupBy(*order).agg(F.count("*").alias("_n"))
    return _stored(positions(folded, list(order), tasks), "keys")


def surrogate_key(df: DataFrame, prepared: DataFrame, order: list[str], name: str, pattern: str = "%d") -> DataFrame:
    """Dense text id in the total order of ``order``, e.g. pattern ``E%05d``; ``prepared`` comes from ``prepare_keys``.

    Lazy: places are turned into ranks by one row count a range, and joined to the rows by key; null keys come first and
    count as equal. A key is meant to be unique; where it isn't, the query fails, since its rows have no order
    (``dense_rank_rows`` breaks such ties). Rows of keys that ``prepared`` lacks get no id.
    """
    placed = prepared.withColumn("_part", F.shiftrightunsigned("_at", _ROW_BITS))
    sizes = placed.groupBy("_part").count()
    # One row per range, so this window is small.
    running = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("count").over(running), F.lit(0)).alias("_before"))
    within = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    rank = F.when(F.col("_n") == 1, F.col("_before") + within + 1).otherwise(F.raise_error(F.lit("a key occurs more than once")))
    ranks = placed.join(offsets, "_part").select(*[F.col(c).alias(f"_key_{c}") for c in order], rank.alias("_rank"))
    same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in order])
    id_text = F.when(F.col("_rank").isNotNull(), F.format_string(pattern, "_rank"))
    return df.join(ranks, same, "left").select(*df.columns, id_text.alias(name))


#: The high bits of the 32-bit hash, by which rows are counted.
_RADIX_BITS = 16


def quota_cohort(
    keys: DataFrame, key: str, quotas: Mapping[str, int], rest: str, name: str = "cohort", seed: str = ""
) -> DataFrame:
    """Cohorts of exact sizes by rank of a hash; what is left over gets ``rest``. Keys are meant to be unique.

    Selection by radix: a histogram of the hash's high bits, at most 65,536 rows, tells how many rows lie before each of
    its buckets. Wherever no quota ends inside a bucket, all its rows belong to one cohort and are labelled as they are
    read; only rows of the few buckets in which a quota ends are sorted. Nothing is written and the bulk of the rows never moves.
    """
    hashed = keys.withColumn("_hash", portable_hash(F.concat(F.lit(seed), F.col(key).cast("string"))))
    hashed = hashed.withColumn("_radix", F.shiftright("_hash", 32 - _RADIX_BITS))
    label, ends, upper = None, [], 0
    for cohort, size in quotas.items():
        upper += size
        ends.append(upper)
        test = F.col("_rank") <= upper
        label = F.when(test, cohort) if label is None else label.when(test, cohort)
    chosen = (F.lit(rest) if label is None else label.otherwise(rest)).alias(name)
    counts = hashed.groupBy("_radix").agg(F.count("*").alias("_n"))
    running = Window.orderBy("_radix").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.select("_radix", "_n", F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_before"))
    cut = F.lit(False)
    for end in ends:
        cut |= (F.col("_before") < end) & (F.lit(end) < F.col("_before") + F.col("_n"))
    placed = placed.select(F.col("_radix").alias("_bucket"), "_before", cut.alias("_cut"))
    of_rows = hashed.join(placed, F.col("_radix").eqNullSafe(F.col("_bucket")))
    others = [f.name for f in keys.schema if isinstance(f.dataType, AtomicType) and f.name != key]
    inside = F.row_number().over(Window.partitionBy("_radix").orderBy("_hash", key, *others))
    whole = of_rows.where(~F.col("_cut")).withColumn("_rank", F.col("_before") + 1)
    sorted_rows = of_rows.where("_cut").withColumn("_rank", F.col("_before") + inside)
    return whole.unionByName(sorted_rows).select(*keys.columns, chosen)
