"""Toxicity by class-conditional Kneser-Ney models.

Each class, toxic and ordinary, has a model of the next byte given three, with absolute discounting of the class's own counts. Both
classes back off to the same Kneser-Ney distribution, made of continuation counts (after how many different bytes an
expression was seen) over all labelled texts: an expression that one class never showed gets its shared probability, and
contexts that neither class knows weigh for neither. Bytes rather than words let inflected and rare forms of a word count together. A text's
evidence is the difference of its two log-likelihoods divided by its length, and the same of the words for which it is positive; a
logistic curve of both turns them into a score. The curve is fitted on a fifth of the labelled texts with counts of the other four fifths,
which did not see them; then the counts are made anew from all.

Counts are exact in Spark and those of the final model cover every labelled text that it is given. The model that goes to the tasks hashes expressions into ``SLOTS``
slots, which bounds its size whatever the corpus; two expressions in one slot share counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from uptake.llm.common import chunks, written
from uptake.llm.hashing import U, buffers, mix

SLOTS = 1 << 20
DISCOUNT = 0.75
#: About so many labelled texts at most fit the logistic curve, chosen by a hash.
CURVE_TEXTS = 20_000
THRESHOLD = 0.7
_BLOCK = 1 << 13
#: Bytes of text counted and scored at once; each takes about sixty or a hundred bytes of arrays, and workers keep what they once took.
_COUNTED, _SCORED = 1 << 20, 1 << 18
_GAP = 32

#: ASCII letters in lower case; ASCII other than letters and digits is a gap.
_fold = np.array([b if b >= 128 or chr(b).isalnum() else _GAP for b in range(256)], np.uint8)
_fold[65:91] += 32


def expressions(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Every four bytes in a row of each text, packed with the last one lowest, and the text's number. Gaps count once; before a text are gaps."""
    data, offsets = buffers(column)
    data = _fold[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    text = np.repeat(np.arange(len(column)), np.diff(offsets))
    gap = data == _GAP
    keep = np.ones(len(data), bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    keep &= ~(gap & first[:-1])
    data, text = data[keep].astype(np.uint32), text[keep]
    out = data.copy()
    for k in (1, 2, 3):
        before = np.full(len(data), _GAP, np.uint32)
        before[k:] = np.where(text[k:] == text[:-k], data[:-k], _GAP)
        out |= before << np.uint32(8 * k)
    return out, text


def slots(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(U)) % U(SLOTS)).astype(np.int64)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each chunk's different expressions with their counts by class."""
    for batch in chunks(batches, "text", _COUNTED):
        keys, text = expressions(batch.column("text"))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)[text]
        both, count = np.unique(keys.astype(np.int64) * 2 + toxic, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(both), pa.array(count)], ["both", "n"])


def _slot_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        slot = slots(batch.column(0).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(slot), *batch.columns[1:]], ["slot", *batch.schema.names[1:]])


def _arrays(frame: DataFrame, values: list[str]) -> list[np.ndarray]:
    """``values`` of ``frame`` (its first column is a key) summed by slot. They reach the driver as blocks of bytes, ``4 * SLOTS`` for each value."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        out = {}
        for v in values:
            block = np.zeros(_BLOCK, np.float32)
            block[rows["slot"].to_numpy() % _BLOCK] = rows[v]
            out[v] = [block.tobytes()]
        return pd.DataFrame({"block": [key[0]], **out})

    hashed = frame.mapInArrow(_slot_rows, "slot long, " + ", ".join(f"{v} long" for v in values))
    sums = hashed.groupBy("slot").agg(*[F.sum(v).alias(v) for v in values])
    blocks = sums.withColumn("block", F.floor(F.col("slot") / _BLOCK).cast("int"))
    rows = blocks.groupBy("block").applyInPandas(pack, "block int, " + ", ".join(f"{v} binary" for v in values)).collect()
    arrays = [np.zeros(SLOTS, np.float32) for _ in values]
    for row in rows:
        for k, v in enumerate(values):
            arrays[k][row.block * _BLOCK : (row.block + 1) * _BLOCK] = np.frombuffer(row[v], np.float32)
    return arrays


def _discounted(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    # Expressions that share a slot could claim more than their context has.
    return np.minimum(np.maximum(count - DISCOUNT, 0), total) / np.maximum(total, 1)


def _spare(kinds: np.ndarray, total: np.ndarray) -> np.ndarray:
    """What discounting leaves for the backoff; all of it in a context never seen."""
    return np.where(total > 0, np.minimum(1, DISCOUNT * kinds / np.maximum(total, 1)), 1).astype(np.float32)


@dataclass
class Model:
    """Arrays of ``SLOTS`` single-precision values, for the classes ordinary (0) and toxic (1), and the shared ones; ``last`` has one for each byte."""

    counts: list[np.ndarray]
    totals: list[np.ndarray]
    spares: list[np.ndarray]
    shared: np.ndarray
    shared_spare: np.ndarray
    last: np.ndarray
    slopes: tuple[float, float] = (1.0, 0.0)
    offset: float = 0.0

    def evidence(self, column: pa.Array) -> np.ndarray:
        """For each text, toxic less ordinary log-likelihood a byte, and that of the words that speak for toxic; 0 for a text without any."""
        keys, text = expressions(column)
        whole, context = slots(keys), slots(keys >> np.uint32(8))
        base = self.backoff(keys)
        logs = [
            np.log(_discounted(self.counts[c][whole].astype(float), self.totals[c][context]) + self.spares[c][context] * base) for c in (0, 1)
        ]
        gain = logs[1] - logs[0]
        # A word's bytes and the gap after it.
        opens = np.ones(len(keys), bool)
        opens[1:] = ((keys[1:] >> np.uint32(8)) & np.uint32(0xFF) == _GAP) | (text[1:] != text[:-1])
        at = np.flatnonzero(opens)
        words = np.add.reduceat(gain, at) if len(at) else gain
        sums = np.stack([np.bincount(text, gain, len(column)), np.bincount(text[at], np.maximum(words, 0), len(column))], axis=1)
        return sums / np.maximum(np.bincount(text, minlength=len(column)), 1)[:, None]

    def backoff(self, keys: np.ndarray) -> np.ndarray:
        """The shared probability of the last byte given the two before it."""
        short = slots(keys & np.uint32(0xFFFFFF))
        context = slots((keys >> np.uint32(8)) & np.uint32(0xFFFF))
        return self.shared[short] + self.shared_spare[context] * self.last[keys & np.uint32(0xFF)]

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ np.array(self.slopes) + self.offset, -30, 30)))


def fit_counts(labelled: DataFrame) -> Model:
    """The two models from all rows of ``labelled`` (``text``, ``toxic``)."""
    rows = labelled.select("text", F.col("toxic").cast("boolean").alias("toxic")).mapInArrow(_count_rows, "both long, n long")
    key, side = F.shiftright("both", 1), F.col("both").bitwiseAND(F.lit(1))
    sums = rows.groupBy(key.alias("key")).agg(*[F.sum(F.when(side == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1)])
    whole = written(sums, "expressions")
    kinds = [(F.col(f"n{c}") > 0).cast("long").alias(f"t{c}") for c in (0, 1)]
    n0, n1 = _arrays(whole, ["n0", "n1"])
    c0, c1, t0, t1 = _arrays(whole.select(F.shiftright("key", 8).alias("key"), "n0", "n1", *kinds), ["n0", "n1", "t0", "t1"])
    # Continuation counts: after how many different bytes the last three, and after how many pairs the last one, were seen.
    short = whole.groupBy(F.col("key").bitwiseAND(F.lit(0xFFFFFF)).alias("key")).agg(F.count("*").alias("n"))
    short = written(short.withColumn("t", F.lit(1).cast("long")), "continuations")
    (s,) = _arrays(short.select("key", "n"), ["n"])
    context = short.select(F.shiftright("key", 8).alias("key"), "n", "t")
    total, follow = _arrays(context, ["n", "t"])
    last = np.ones(256)
    for row in short.groupBy(F.col("key").bitwiseAND(F.lit(0xFF)).alias("byte")).agg(F.count("*").alias("n")).collect():
        last[row.byte] += row.n
    # Each three-byte slot's discounted share needs its context's total, which the keys tell.
    share = _shares(short, total)
    return Model(
        [n0, n1], [c0, c1], [_spare(t0, c0), _spare(t1, c1)], share if s.any() else np.zeros(SLOTS, np.float32), _spare(follow, total), last / last.sum()
    )


def _shares(short: DataFrame, total: np.ndarray) -> np.ndarray:
    """By slot, the discounted share of three bytes among those with the same first two."""
    shipped = short.sparkSession.sparkContext.broadcast(total)
    scale = 1 << 40

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("key").to_numpy().astype(np.uint32)
            share = _discounted(batch.column("n").to_numpy(), shipped.value[slots(keys >> np.uint32(8))])
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array((share * scale).astype(np.int64))], ["key", "n"])

    (share,) = _arrays(short.select("key", "n").mapInArrow(rows, "key long, n long"), ["n"])
    shipped.destroy()
    return share / np.float32(scale)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[tuple[float, float], float]:
    """Slopes and offset by Newton steps with a slight pull to 0."""
    if len(x) == 0:
        return (1.0, 0.0), 0.0
    scale = np.maximum(x.std(axis=0), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(3), a.T @ (y - p) - 1e-2 * w)
        w += np.clip(step, -4, 4)
    return (float(w[0] / scale[0]), float(w[1] / scale[1])), float(w[2])


def fit(labelled: DataFrame) -> Model:
    """The model from labelled rows ``doc_id, text, toxic``: all of them give the counts, and the curve comes from ``_curve``.

    The rows are written once, so that their texts are joined with the labels only once.
    """
    known = written(labelled.where("toxic is not null and toxic in (0, 1)").select("doc_id", "text", "toxic"), "labelled")
    slopes, offset = _curve(known)
    model = fit_counts(known)
    model.slopes, model.offset = slopes, offset
    return model


def _curve(known: DataFrame) -> tuple[tuple[float, float], float]:
    """The logistic curve, fitted on rows of one fifth by a model that counts only the others."""
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(5))
    fifth = known.where(part == 0)
    share = min(1.0, CURVE_TEXTS / max(1, fifth.count()))
    rest = fifth.where(F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(1 << 32)) < int(share * (1 << 32)))
    shipped = rest.sparkSession.sparkContext.broadcast(fit_counts(known.where((part != 0) | part.isNull())))
    seen = rest.select("text", "toxic").mapInArrow(_evidence_rows(shipped), "toxic int, all double, peaks double").toPandas()
    shipped.destroy()
    return _logistic(seen[["all", "peaks"]].to_numpy(), seen["toxic"].to_numpy(dtype=float))


def _evidence_rows(shipped):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", _SCORED):
            found = shipped.value.evidence(batch.column("text"))
            columns = [batch.column("toxic").cast(pa.int32()), pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())]
            yield pa.RecordBatch.from_arrays(columns, ["toxic", "all", "peaks"])

    return rows


def score(docs: DataFrame, model: Model, name: str = "_score") -> DataFrame:
    """All columns of ``docs`` with the score as ``name``, from ``text`` alone."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    kind = StructType([*docs.schema.fields, StructField(name, DoubleType())])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", _SCORED):
            found = shipped.value.scores(shipped.value.evidence(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, name])

    return docs.mapInArrow(rows, kind)


def held_out(name: str = "doc_id") -> Column:
    """Whether the crc32 of the id as text leaves 1 modulo 3; a null id is held out of nothing."""
    return F.coalesce(F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of the labelled rows that are not held out; contradicting labels of one id count as toxic."""
    marks = labels.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The same plan at every size: a broadcast of labels would end where they outgrow the threshold.
    return docs.where(~held_out()).select("doc_id", "text").join(marks.hint("merge"), "doc_id")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``.

    Learns only from labelled rows that are not held out. Defined cases: a null or
    empty text has no evidence and gets the score of evidence 0; rows with null labels teach
    nothing; without usable labels every score is 0.5; rows with one id are scored each by its text.
    """
    model = fit(training_rows(docs, labels))
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )
