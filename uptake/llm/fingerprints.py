"""Document fingerprints: SimHash of weighted terms, and search by permuted block tables."""

from __future__ import annotations

import hashlib
import itertools
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from uptake.llm.common import chunks, row_order, written
from uptake.llm.hashing import Sums, U, Words, bit_votes, mix, pack_bits

BITS, TERM = 128, 3
RADIUS, BLOCKS = 3, 5


def fingerprints(texts: pa.Array) -> np.ndarray:
    """128 bits for each text, as two unsigned values.

    Terms are runs of up to three words; of a text with fewer, all its words. A term that occurs n times has
    weight 1 + log2(n), so that repeated lines don't drown the rest. Each
    term's hash votes with its weight for every bit that it sets and against the others.
    """
    words = Words(texts)
    sums = Sums(words.hash)
    at = np.arange(len(words))
    last = words.first[words.text + 1]
    # A text of fewer words than a term holds has one term, at its first word.
    starts = at[(at + TERM <= last) | (at == words.first[words.text])]
    terms = sums.of(starts, np.minimum(starts + TERM, last[starts]))
    text = words.text[starts]
    order = np.lexsort((terms, text))
    new = np.ones(len(order), bool)
    new[1:] = (terms[order][1:] != terms[order][:-1]) | (text[order][1:] != text[order][:-1])
    first = np.flatnonzero(new)
    weight = 1 + np.log2(np.diff(np.append(first, len(order))))
    terms, text = terms[order][first], text[order][first]
    total = np.bincount(text, weight, minlength=len(texts))[:, None]
    halves = [terms, mix(terms ^ U(0x6A09E667F3BCC909))]
    return np.stack([pack_bits(2 * bit_votes(h, text, len(texts), weight) > total) for h in halves], axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine that the number of differing bits stands for, at least 0: 1 for equal fingerprints, about 0 for unrelated texts."""
    differing = np.bitwise_count(a ^ b).sum(axis=1)
    return np.maximum(0, np.cos(np.pi * differing / BITS))


def _hex(fp: np.ndarray) -> list[str]:
    return [f"{a:016x}{b:016x}" for a, b in fp.tolist()]


def _edited(text: str, donor: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + donor[:n]


_FIELDS = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double,"
    " f1 long, f2 long"
)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and order; each is answered once the one after it is known. A bucket ends in a copy."""
    held = None
    for batch in chunks(batches, "text"):
        if held is not None:
            batch = pa.concat_batches([held, batch])
        held = batch.slice(batch.num_rows - 1)
        yield from _answers(batch)


def _answers(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    bucket, copy = batch.column("bucket").to_pylist(), batch.column("copy").to_pylist()
    texts = [t or "" for t in batch.column("text").to_pylist()]
    own = [k for k in range(len(texts) - 1) if not copy[k] and bucket[k] == bucket[k + 1]]
    if not own:
        return
    edited = pa.array([_edited(texts[k], texts[k + 1]) for k in own])
    prints, after = fingerprints(pa.array(texts)), fingerprints(edited)
    at = np.array(own)
    yield pa.RecordBatch.from_arrays(
        [
            batch.column("row").take(pa.array(at)),
            pa.array([len(texts[k]) for k in own]),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited.to_pylist()]),
            pa.array(_hex(prints[at])),
            pa.array(_hex(after)),
            pa.array(likeness(prints[at], after)),
            pa.array(likeness(prints[at], prints[at + 1])),
            pa.array(prints[at, 0].view(np.int64)),
            pa.array(prints[at, 1].view(np.int64)),
        ],
        ["row", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "f1", "f2"],
    )


def _bounds(ids: DataFrame) -> list[int]:
    """The first id of each of about four ranges a shuffle partition, of like numbers of rows. One value a range reaches the driver."""
    parts = 4 * int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    least = ids.repartitionByRange(parts, "ord").groupBy(F.spark_partition_id()).agg(F.min("ord").alias("least"))
    return sorted({r.least for r in least.collect()})


def _dealt(bounds: list[int]):
    """Each row goes to its range; the first of a range also, as a copy, to the end of the range before (round the table)."""
    firsts = set(bounds)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = batch.column("ord").to_pylist()
            mine = [bisect_right(bounds, x) - 1 for x in order]
            yield _with(batch, mine, False)
            again = [k for k, x in enumerate(order) if x in firsts]
            if again:
                before = [(mine[k] - 1) % len(bounds) for k in again]
                yield _with(batch.take(pa.array(again)), before, True)

    def _with(batch: pa.RecordBatch, bucket: list[int], copy: bool) -> pa.RecordBatch:
        n = batch.num_rows
        return pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(bucket, pa.int32()), pa.array([copy] * n, pa.bool_())], [*batch.schema.names, "bucket", "copy"]
        )

    return rows


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Every row's fingerprint, that of its edited text, and how alike they and the next row's are.

    The edited text has its last floor(n / 4) code points replaced by as many first ones (or all) of the
    next row by ascending ``doc_id``; after the last row comes the first, which for a single row is itself. Defined
    cases: a null text is empty and has fingerprint zero; null ids come first; rows that
    share a ``doc_id`` follow each other by their text; other columns are ignored.
    """
    ids = docs.select(row_order().alias("ord"))
    bounds = _bounds(ids)
    texts = docs.select(F.col("doc_id").alias("row"), row_order().alias("ord"), F.coalesce("text", F.lit("")).alias("text"))
    kind = StructType([*texts.schema.fields, *StructType.fromDDL("bucket int, copy boolean").fields])
    dealt = texts.mapInArrow(_dealt(bounds), kind) if bounds else texts.selectExpr("*", "0 as bucket", "false as copy")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Of rows that share the first id of a range, only the first by text serves the range before: the others come after it.
    ranged = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "copy", "ord", "text")
    id_field = StructField("row", docs.schema["doc_id"].dataType)
    out = ranged.mapInArrow(_pairs, StructType([id_field, *StructType.fromDDL(_FIELDS).fields]))
    return out.withColumnRenamed("row", "doc_id")


def _block_rows(radius: int, blocks: int):
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    chosen = list(itertools.combinations(range(blocks), blocks - radius))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f1, f2 = batch.column("f1").to_numpy(), batch.column("f2").to_numpy()
            both = np.stack([f1, f2], axis=1).view(np.uint8).reshape(len(f1), 16)
            bits = np.unpackbits(both, axis=1, bitorder="little")
            for number, some in enumerate(chosen):
                # The chosen blocks moved to the front are the key of this table.
                front = np.concatenate([bits[:, edges[b] : edges[b + 1]] for b in some], axis=1)
                packed = np.zeros((len(f1), 16), np.uint8)
                packed[:, : (front.shape[1] + 7) // 8] = np.packbits(front, axis=1)
                words = packed.view("<u8")
                key = mix(words[:, 0].astype(U) + mix(words[:, 1].astype(U) + U(number)))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(f1), pa.array(f2)], ["key", "f1", "f2"])

    return rows


def neighbours(fps: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``f1, f2, g1, g2``: every pair of different fingerprints, given as distinct rows, within ``radius`` bits, both ways round.

    Cut into ``blocks`` blocks, two such fingerprints agree in ``blocks - radius`` of them. There is a
    table for each such choice; matches are verified on all bits.
    """
    rows = fps.select("f1", "f2").mapInArrow(_block_rows(radius, blocks), "key long, f1 long, f2 long")
    other = rows.select("key", F.col("f1").alias("g1"), F.col("f2").alias("g2"))
    apart = F.bit_count(F.col("f1").bitwiseXOR(F.col("g1"))) + F.bit_count(F.col("f2").bitwiseXOR(F.col("g2")))
    found = rows.join(other, (rows.key == other.key) & (apart <= radius) & (apart > 0))
    return found.select("f1", "f2", "g1", "g2").distinct()


def with_neighbours(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Adds ``near_prints``: how many other fingerprints of the table lie within ``radius`` bits."""
    marked = written(marked, "prints")
    distinct = written(marked.select("f1", "f2").distinct(), "distinct-prints")
    count = neighbours(distinct, radius).groupBy("f1", "f2").agg(F.count("*").alias("near_prints"))
    joined = marked.join(count, ["f1", "f2"], "left").withColumn("near_prints", F.coalesce("near_prints", F.lit(0).cast(LongType())))
    return joined.drop("f1", "f2")


