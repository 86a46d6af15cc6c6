"""Removal of repeated word windows, found by recompression.

Each text is a sequence of words. Rounds rename it: a round first turns maximal
runs of one symbol into one symbol, then merges pairs whose left symbol falls
into the left half of the alphabet and whose right symbol into the right half. A
symbol's name is a hash of what it stands for, so all tasks of the Spark job
give one content one name and equal passages get equal symbols, but for a
margin: with each symbol goes the stretch of words that decided it.

0. Whole texts are the highest symbols: a text whose words all equal an earlier text's goes at once.
1. Every window takes as its anchor the smallest-named symbol of the highest
   round whose deciding stretch lies inside the window. Equal windows take equal
   anchors. A shuffle by name tells which anchors occur more than once.
2. Only windows below a shared anchor are compared in full, by a 128-bit hash
   of their words; a second shuffle finds each window's first place.
3. Words covered by a window that starts earlier elsewhere go.

Before each shuffle a task keeps one row for each name in a chunk of its text, so a
passage that a third of all texts share sends one row a chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from uptake.llm.common import chunks, row_order, written
from uptake.llm.hashing import Sums, U, Words, mix

ROUNDS = 2


class Symbols:
    """The symbols of one round over the words of many texts, in order."""

    def __init__(self, name, start, end, left, right, text):
        self.name, self.start, self.end, self.left, self.right, self.text = name, start, end, left, right, text

    def _neighbours(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Where the deciding stretches of the symbols before and after begin and end; outside the text if there is none."""
        before = words.first[self.text] - 1
        after = words.first[self.text + 1] + 1
        same = self.text[1:] == self.text[:-1]
        before[1:][same] = self.left[:-1][same]
        after[:-1][same] = self.right[1:][same]
        return before, after

    def runs(self, words: Words) -> Symbols:
        if not len(self.name):
            return self
        head = np.ones(len(self.name), bool)
        head[1:] = (self.name[1:] != self.name[:-1]) | (self.text[1:] != self.text[:-1])
        at = np.flatnonzero(head)
        last = np.append(at[1:], len(head)) - 1
        length = (last - at + 1).astype(U)
        before, after = self._neighbours(words)
        name = np.where(length > 1, mix(self.name[at] + mix(length)), self.name[at])
        return Symbols(name, self.start[at], self.end[last], before[at], after[last], self.text[at])

    def pairs(self, words: Words, number: int) -> Symbols:
        if not len(self.name):
            return self
        opens = (mix(self.name + U(number)) & U(1)).astype(bool)
        joins = np.zeros(len(opens), bool)
        joins[:-1] = opens[:-1] & ~opens[1:] & (self.text[1:] == self.text[:-1])
        second = np.zeros(len(opens), bool)
        second[1:] = joins[:-1]
        before, after = self._neighbours(words)
        at = np.flatnonzero(~second)
        mate = at + joins[at]
        name = np.where(joins[at], mix(self.name[at] * U(3) + mix(self.name[mate] + U(7))), self.name[at])
        # A lone opening symbol was decided by what follows, a lone closing one by what precedes.
        left = np.where(joins[at] | opens[at], self.left[at], before[at])
        right = np.where(joins[at] | ~opens[at], self.right[mate], after[at])
        return Symbols(name, self.start[at], self.end[mate], left, right, self.text[at])


def recompress(words: Words, rounds: int = ROUNDS) -> list[Symbols]:
    """The symbols after each round, lowest first."""
    at = np.arange(len(words))
    now = Symbols(words.hash, at, at + 1, at, at + 1, words.text)
    out = []
    for number in range(rounds):
        now = now.runs(words).pairs(words, number)
        out.append(now)
    return out


def _range_argmin(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, longest: int) -> np.ndarray:
    """The first place of the minimum of values[lo:hi] for each slice of at most ``longest``; -1 if it is empty."""
    out = np.full(len(lo), -1)
    size = hi - lo
    level, width = np.arange(len(values)), 1
    while width <= longest:
        some = np.flatnonzero((size >= width) & (size < 2 * width))
        a, b = level[lo[some]], level[hi[some] - width]
        out[some] = np.where(values[b] < values[a], b, a)
        if len(level) <= width:
            break
        a, b = level[: len(level) - width], level[width:]
        level = np.where(values[b] < values[a], b, a)
        width *= 2
    return out


def window_starts(words: Words, width: int) -> np.ndarray:
    """The word positions at which a window of ``width`` words of one text starts."""
    at = np.arange(len(words))
    return at[at + width <= words.first[words.text + 1]]


def anchors(words: Words, sums: Sums, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window the name of its anchor, which equal windows share and others rarely, and a number that tells anchors apart."""
    name = np.zeros(len(starts), U)
    number = np.full(len(starts), -1)
    todo = np.arange(len(starts))
    for level, s in reversed(list(enumerate(recompress(words)))):
        if not len(todo) or not len(s.name):
            break
        left = np.minimum.accumulate(s.left[::-1])[::-1]
        right = np.maximum.accumulate(s.right)
        lo, hi = np.clip(s.left, 0, len(words)), np.clip(s.right, 0, len(words))
        rank = mix(sums.of(lo, hi) + mix(s.name + (s.start - s.left).astype(U) + U(level << 8)))
        n = len(words) + width + 2
        opened = np.cumsum(np.bincount(np.clip(left + 1, 0, n), minlength=n + 1))
        closed = np.cumsum(np.bincount(np.clip(right, 0, n), minlength=n + 1))
        at = starts[todo]
        lo, hi = opened[at], closed[at + width]
        found = _range_argmin(rank, lo, np.maximum(hi, lo), width)
        some = found >= 0
        name[todo[some]] = rank[found[some]]
        number[todo[some]] = found[some] * 4 + level
        todo = todo[~some]
    # A window without any symbol of its own, such as one inside a long run, is its own anchor.
    name[todo] = mix(sums.of(starts[todo], starts[todo] + width) + U(1))
    number[todo] = starts[todo] * 4 + 3
    return name, number


def _merge(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The unions of ranges that touch, for each text; the ranges come sorted by text and start."""
    if not len(text):
        return text, start, end
    reach = np.maximum.accumulate(end)
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return text[at], start[at], reach[np.append(at[1:], len(new)) - 1]


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns.values()], list(columns))


def _span(start: np.ndarray, end: np.ndarray, mark: np.ndarray | int = 0) -> np.ndarray:
    """A word range and a mark from 0 to 3 in one value, so that rows stay narrow."""
    return (np.asarray(start, np.int64) << 32) | (np.asarray(end, np.int64) << 2) | mark


def _ranges(rows: DataFrame) -> DataFrame:
    span = F.col("span")
    return rows.groupBy("ord", "rid").agg(F.collect_list(span).alias("ranges"))


_ANCHORS = "key long, ord long, rid long, span long"


def _anchor_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = Words(batch.column("text"))
            starts = window_starts(words, width)
            if not len(starts):
                continue
            order = batch.column("ord").to_numpy()
            rid = batch.column("rid").to_numpy()
            names, number = anchors(words, Sums(words.hash), starts, width)
            text = words.text[starts]
            new = np.ones(len(starts), bool)
            new[1:] = (number[1:] != number[:-1]) | (text[1:] != text[:-1])
            at = np.flatnonzero(new)
            end = starts[np.append(at[1:], len(new)) - 1] + 1
            name, text, start = names[at], text[at], starts[at]
            # One row for each name goes to the shuffle; where a name repeats here, its places are known to be shared.
            _, one, back, count = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
            known = np.flatnonzero(count[back] > 1)
            t, s, e = _merge(text[known], start[known], end[known])
            base = words.first[t]
            yield _batch(
                key=mix(rid[t].view(U) + s.astype(U)).view(np.int64), ord=order[t], rid=rid[t], span=_span(s - base, e - base, 1)
            )
            t, base = text[one], words.first[text[one]]
            yield _batch(
                key=name[one].view(np.int64), ord=order[t], rid=rid[t],
                span=_span(start[one] - base, end[one] - base, np.where(count > 1, 2, 0)),
            )

    return rows


_WINDOWS = "h1 long, h2 long, ord long, rid long, span long"


def _window_rows(width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text"):
            words = Words(batch.column("text"))
            starts = window_starts(words, width)
            starts = starts[_covered(words, batch.column("ranges"))[starts]]
            if not len(starts):
                continue
            order, rid = batch.column("ord").to_numpy(), batch.column("rid").to_numpy()
            h1 = Sums(words.hash).of(starts, starts + width)
            h2 = Sums(mix(words.hash + U(0x5851F42D4C957F2D))).of(starts, starts + width)
            text = words.text[starts]
            place = starts - words.first[text]
            by = np.lexsort((place, order[text], h2, h1))
            new = np.ones(len(by), bool)
            new[1:] = (h1[by][1:] != h1[by][:-1]) | (h2[by][1:] != h2[by][:-1])
            first = by[np.flatnonzero(new)]
            own = first[np.cumsum(new) - 1]
            # Later than the first of its kind in this chunk: late whatever other chunks hold. Rows that tie with it stay equal.
            later = (order[text[by]] != order[text[own]]) | (place[by] != place[own])
            late = np.sort(by[later])
            t, s, e = _merge(text[late], starts[late], starts[late] + width)
            base = words.first[t]
            own_key = mix(rid[t].view(U) + s.astype(U)).view(np.int64)
            yield _batch(h1=own_key, h2=own_key, ord=order[t], rid=rid[t], span=_span(s - base, e - base, 1))
            keep = by[~later]
            t = text[keep]
            yield _batch(
                h1=h1[keep].view(np.int64), h2=h2[keep].view(np.int64), ord=order[t], rid=rid[t],
                span=_span(place[keep], place[keep] + width),
            )

    return rows


def _covered(words: Words, ranges: pa.Array) -> np.ndarray:
    """Whether each word position lies in a range of its text."""
    step = np.zeros(len(words) + 1, np.int64)
    flat = ranges.flatten()
    if len(flat):
        at = np.repeat(words.first[:-1], pa.compute.fill_null(pa.compute.list_value_length(ranges), 0).to_numpy())
        span = flat.to_numpy()
        step += np.bincount(at + (span >> 32), minlength=len(step))
        step -= np.bincount(at + ((span & 0xFFFFFFFF) >> 2), minlength=len(step))
    return np.cumsum(step)[:-1] > 0


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "text"):
        words = Words(batch.column("text"))
        copy = batch.column("copy").to_numpy(zero_copy_only=False)
        gone = _covered(words, batch.column("ranges")) | copy[words.text]
        removed = np.add.reduceat(np.append(gone, False).astype(np.int64), words.first[:-1]) * (words.counts > 0)
        kept = []
        for k, text in enumerate(batch.column("text").to_pylist()):
            own = (text or "").encode().split()
            if removed[k]:
                flags = gone[words.first[k] : words.first[k + 1]].tolist()
                own = [w for w, out in zip(own, flags, strict=True) if not out]
            kept.append(b" ".join(own).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), pa.array(words.counts), pa.array(removed), pa.array(kept)],
            ["row", "n_words", "n_removed", "kept"],
        )


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _kept(batches):
        digest = [hashlib.sha256(t.encode()).hexdigest() for t in batch.column("kept").to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(digest)], ["row", "n_words", "n_removed", "kept_sha256"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's number of words and the name of all of it."""
    for batch in chunks(batches, "text"):
        words = Words(batch.column("text"))
        first, last = words.first[:-1], words.first[1:]
        h1 = Sums(words.hash).of(first, last).view(np.int64)
        h2 = Sums(mix(words.hash + U(0x5851F42D4C957F2D))).of(first, last).view(np.int64)
        yield _batch(ord=batch.column("ord").to_numpy(), rid=batch.column("rid").to_numpy(), n=words.counts, h1=h1, h2=h2)


def _copies(texts: DataFrame, width: int) -> DataFrame:
    """``ord, rid`` of the texts of ``width`` words or more that an earlier text equals."""
    whole = written(texts.mapInArrow(_whole, "ord long, rid long, n long, h1 long, h2 long").where(F.col("n") >= width), "wholes")
    first = written(whole.groupBy("h1", "h2").agg(F.min("ord").alias("first"), F.count("*").alias("m")).where("m > 1"), "first-wholes")
    later = whole.join(first, ["h1", "h2"]).where("ord > first")
    return later.select("ord", "rid", F.lit(True).alias("copy")).distinct()


def remove_repeats(docs: DataFrame, width: int = 20, digest: bool = False) -> DataFrame:
    """Every row of ``docs`` without the words that an earlier equal window covers.

    Returns ``doc_id, n_words, n_removed`` and the kept words joined by one space as
    ``kept``, or with ``digest`` only their SHA-256 as ``kept_sha256``. Windows are judged on the input.
    Defined cases: a null text has no words; a null ``doc_id`` comes before all others;
    rows that share a ``doc_id`` count as one place, so repeated rows do not
    remove each other; other columns are ignored; an empty table gives an empty result.
    """
    texts = docs.select(
        F.col("doc_id").alias("row"), row_order().alias("ord"), F.xxhash64("doc_id", "text").alias("rid"), "text"
    )
    copies = written(_copies(texts.select("ord", "rid", "text"), width), "copies")
    own = texts.select("ord", "rid", "text").join(copies, ["ord", "rid"], "left_anti")
    mark = F.col("span").bitwiseAND(F.lit(3))
    named = own.mapInArrow(_anchor_rows(width), _ANCHORS)
    # Mark 1: places known to be shared; they have keys of their own. Mark 2: known, but others need the name.
    shared = named.withColumn("_n", F.count("*").over(Window.partitionBy("key"))).where((mark > 0) | (F.col("_n") > 1))
    # This join and the last one read the same exchange of the texts; copies have no ranges here.
    windows = texts.join(_ranges(shared), ["ord", "rid"]).mapInArrow(_window_rows(width), _WINDOWS)
    place = F.struct("ord", "span")
    first = F.min(place).over(Window.partitionBy("h1", "h2"))
    late = windows.withColumn("_first", first).where((mark == 1) | (place > F.col("_first")))
    out = texts.join(_ranges(late), ["ord", "rid"], "left").join(copies, ["ord", "rid"], "left")
    out = out.withColumn("copy", F.coalesce("copy", F.lit(False)))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    cleaned = out.mapInArrow(
        _with_digest if digest else _kept,
        f"row {id_type}, n_words long, n_removed long, {'kept_sha256' if digest else 'kept'} string",
    )
    return cleaned.withColumnRenamed("row", "doc_id")
