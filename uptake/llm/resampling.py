"""Documents drawn so that their word runs follow a target's, by importance weights over hashed features.

A feature is a run of consecutive words; its bucket is the CRC-32 of its bytes modulo ``buckets``. A
bucket's gain is the logarithm of its share in the target over its share in the documents, a document's
weight the mean gain of its features, and its score the weight with Gumbel noise, so that the highest
scores are a draw without replacement.

CRC-32 is linear over exclusive or, but for a constant of the length: each byte adds a value that depends
on itself and its distance from the end alone. A table holds these values for ``BLOCK`` distances, so one
gather and one ``bitwise_xor.reduceat`` over the features' spans give all CRCs of a chunk. A longer span is
cut into blocks counted from its end; the value so far moves past a block of zero bytes, which is
four look-ups in the same table, and takes up the next block.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import chunks, numbered, prefix_sums, row_order, written
from uptake.llm.hashing import buffers

#: Distances from a span's end that the table covers; at least 4.
BLOCK = 64
BUCKETS = 10_000
RUN = 2
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

#: Bytes of words: digits, letters and all of the characters beyond ASCII.
_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x41:0x5B] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32


def _position_table() -> np.ndarray:
    """``[d * 256 + b]``: what byte b adds to the CRC at d bytes before the end."""
    row = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
    rows = [row]
    for _ in range(BLOCK - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ row[rows[-1] & np.uint32(255)])
    return np.concatenate(rows)


_TABLE = _position_table()
#: The CRC of as many zero bytes.
_ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(1024)], np.uint32)


def _constants(sizes: np.ndarray) -> np.ndarray:
    out = _ZEROS[np.minimum(sizes, len(_ZEROS) - 1)]
    for n in np.unique(sizes[sizes >= len(_ZEROS)]).tolist():
        out[sizes == n] = zlib.crc32(bytes(n))
    return out


def _past_block(value: np.ndarray) -> np.ndarray:
    """What a prefix has added to the CRC, after ``BLOCK`` more bytes."""
    out = np.zeros(len(value), np.uint32)
    for k in range(4):
        out ^= _TABLE[(BLOCK - 1 - k) * 256 + ((value >> np.uint32(8 * k)) & np.uint32(255)).astype(np.int64)]
    return out


def span_crcs(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The CRC-32 of each span of ``data``; spans have at least one byte."""
    if not len(starts):
        return np.zeros(0, np.uint32)
    size = ends - starts
    blocks = (size + BLOCK - 1) // BLOCK
    first = np.cumsum(blocks) - blocks
    # Blocks count from the span's end, so that the first one of a span may be short.
    number = np.arange(blocks.sum()) - np.repeat(first, blocks)
    stop = np.repeat(ends, blocks) - (np.repeat(blocks, blocks) - 1 - number) * BLOCK
    begin = np.maximum(stop - BLOCK, np.repeat(starts, blocks))
    held = stop - begin
    at = np.cumsum(held) - held
    place = np.arange(held.sum()) + np.repeat(begin - at, held)
    distance = np.repeat(stop - 1, held) - place
    added = np.bitwise_xor.reduceat(_TABLE[distance * 256 + data[place]], at)
    value = added[first]
    todo, k = np.flatnonzero(blocks > 1), 1
    while len(todo):
        value[todo] = _past_block(value[todo]) ^ added[first[todo] + k]
        k += 1
        todo = todo[blocks[todo] > k]
    return value ^ _constants(size)


class Features:
    """The features of a chunk of texts: the text of each and its CRC; and each text's number of words."""

    def __init__(self, column: pa.Array, run: int):
        data, offsets = buffers(column)
        inside = _WORD[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        start = np.flatnonzero(inside & (edge[:-1] | ~np.append(False, inside[:-1])))
        end = np.flatnonzero(inside & (edge[1:] | ~np.append(inside[1:], False))) + 1
        n, size = len(start), end - start
        first = np.searchsorted(start, offsets)
        self.words = np.diff(first)
        owner = np.repeat(np.arange(len(column)), self.words)
        # All words once more, with one space after each, so that every run is one span.
        stream = np.full(size.sum() + n, 0x20, np.uint8)
        stream[np.arange(size.sum()) + np.repeat(np.arange(n), size)] = _FOLD[data[inside]]
        begin = np.cumsum(size + 1) - (size + 1)
        texts, crcs = [], []
        for length in range(1, run + 1):
            for k in range(length):
                # Every ``length``-th run, so that the spans of a pass follow each other.
                i = np.arange(k, n - length + 1, length)
                i = i[owner[i] == owner[i + length - 1]]
                texts.append(owner[i])
                crcs.append(span_crcs(stream, begin[i], (begin + size)[i + length - 1]))
        self.text, self.crc = np.concatenate(texts), np.concatenate(crcs)


def _count_rows(run: int, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in chunks([batch], "text"):
                sums += np.bincount(Features(part.column("text"), run).crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], ["bucket", "n"])

    return rows


def bucket_counts(texts: DataFrame, run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``text`` each bucket holds: one row a task and bucket meets the shuffle, ``buckets`` rows the driver."""
    counted = texts.select("text").mapInArrow(_count_rows(run, buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(held: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's smoothed share in the target over that in the documents."""
    s, t = (x.sum().item() + len(x) for x in (held, wanted))
    pairs = zip(held.tolist(), wanted.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log(((w + 1.0) * s) / ((h + 1.0) * t))) for h, w in pairs], np.int64)


def _weight_rows(run: int, gain):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = gain.value
        for batch in chunks(batches, "text"):
            found = Features(batch.column("text"), run)
            n = np.bincount(found.text, minlength=batch.num_rows)
            # The sums stay far below 2^53, so doubles hold them exactly.
            total = np.bincount(found.text, table[found.crc % np.uint32(len(table))], minlength=batch.num_rows).astype(np.int64)
            weight = total // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("uid"), batch.column("row"), batch.column("ord"), pa.array(found.words), pa.array(n), pa.array(weight)],
                ["uid", "row", "ord", "n_words", "n_features", "weight"],
            )

    return rows


def _scored(rows: DataFrame, target: DataFrame, id_type: str, run: int, buckets: int, seed: int) -> DataFrame:
    """``uid, row, ord, n_words, n_features, weight, score`` of ``rows`` (``uid, row, ord, text``), written once."""
    gain = gains(bucket_counts(rows, run, buckets), bucket_counts(target, run, buckets))
    shipped = rows.sparkSession.sparkContext.broadcast(gain)
    kind = f"uid long, row {id_type}, ord long, n_words long, n_features long, weight long"
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("row").cast("string"), F.lit("")))
    noise = (F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("long") + 0.5) / 4294967296.0
    score = F.col("weight") + F.floor(-1000 * F.log(-F.log(noise))).cast("long")
    return written(rows.mapInArrow(_weight_rows(run, shipped), kind).withColumn("score", score), "weights")


def _ranked(scored: DataFrame, least_words: int, percent: int) -> DataFrame:
    """``scored`` with ``rank``, null for rows that aren't drawn."""
    enough = F.col("n_words") >= least_words
    draws = scored.where(enough).count() * percent // 100
    narrow = scored.where(enough).select("*", (-F.col("score")).alias("falling"), F.lit(1).cast("long").alias("one"))
    # Rows that are equal up to here are the same document's, and ``uid`` deals them out over partitions.
    placed = prefix_sums(narrow, [], ["falling", "ord", "n_features", "weight", "uid"], "one", "before")
    ranked = placed.withColumn("rank", F.when(F.col("before") < draws, F.col("before") + 1)).drop("falling", "one", "before")
    return ranked.unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))


def importance(
    docs: DataFrame,
    target: DataFrame,
    run: int = RUN,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every row of ``docs``, for the ``text`` of ``target``.

    Defined cases: a null or empty text has no features and weight 0; a null ``doc_id`` is
    hashed as an empty text and wins ties; rows that share a ``doc_id`` are drawn each for itself, in the order
    of their number of features and their weight; with an empty target every gain depends on the documents alone; an empty
    table gives an empty result; other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").alias("row"), row_order().alias("ord"), "text")
    ranked = _ranked(_scored(rows, target, id_type, run, buckets, seed), least_words, percent)
    return ranked.select(F.col("row").alias("doc_id"), "n_words", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``importance`` draws, with all their columns and nothing else."""
    settings = {"run": RUN, "buckets": BUCKETS, "seed": SEED, "least_words": LEAST_WORDS, "percent": PERCENT} | settings
    whole = numbered(docs)
    rows = whole.select("uid", F.col("whole.doc_id").alias("row"), row_order("whole.doc_id").alias("ord"), F.col("whole.text").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    scored = _scored(rows, target, id_type, settings["run"], settings["buckets"], settings["seed"])
    chosen = _ranked(scored, settings["least_words"], settings["percent"]).where("rank is not null").select("uid")
    return whole.join(chosen, "uid", "left_semi").select("whole.*")
