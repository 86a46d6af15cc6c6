"""Removal of repeated byte strings, found by building suffix order column by column.

1. Every window of ``width`` bytes takes as its anchor the smallest-named run of ``GRAM`` bytes in it.
   Neighbouring windows with one anchor form a piece: their bytes, and how far the anchor lies from the
   start. Equal windows have equal anchors at equal distances, so a shuffle of pieces by anchor
   brings them together, and only windows at the same distance can be equal.
2. A collection of pieces is aligned at its anchors and built from the right, one column a round: each
   piece that reaches the column inserts one symbol. The symbols in front of the sorted
   suffixes are the column's Burrows-Wheeler transform; dealing them out by symbol, in order,
   sorts the suffixes longer by one. The common prefix of two neighbours grows by one from the
   least one between them. Older columns are not needed any more, since their windows can't
   equal those of this one, so a round reads and writes one column only.
3. Neighbours whose common prefix reaches ``width`` are equal windows: all but the first place go.

The pieces of a collection are streamed from the sorted files of Spark's shuffle. Before the
shuffle a task drops pieces that equal an earlier one of its chunk, so a passage that a third
of all texts share is sent once a chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uptake.llm.common import chunks, row_order
from uptake.llm.hashing import U, buffers, mix

WIDTH = 100
#: Bytes of an anchor.
GRAM = 16
#: Bytes of text whose pieces one collection holds, on average.
COLLECTION_BYTES = 8 << 20
#: Bytes of text that a task cuts into pieces at once; each takes about a hundred bytes of arrays.
CUT_BYTES = 3 << 20
#: An anchor with so many distinct pieces in one chunk gives way to others wherever a window has another.
CROWDED = 64
#: At most so many anchors give way, the most frequent first.
MOST_CROWDED = 1 << 16

_LETTER = (mix(np.arange(1, 257, dtype=U)) >> U(32)).astype(np.uint32)
_STEP = {1: 0x9E3779B1, 2: 0x85EBCA6B, 4: 0xC2B2AE35, 8: 0x27D4EB2F, 16: 0x165667B1}
_CODEC, _LEVEL = "zstd", 3


def gram_names(data: np.ndarray, size: int) -> np.ndarray:
    """A 32-bit name of the ``size`` bytes from each position on."""
    power, names = 1, _LETTER[data]
    done, out = 0, None
    while True:
        if size & power:
            if out is None:
                out = names
            else:
                n = max(0, len(data) - done - power + 1)
                out = out[:n] * np.uint32(_STEP[power]) + names[done : done + n]
            done += power
        if 2 * power > size:
            break
        names = names[:-power] * np.uint32(_STEP[power] ^ 0x5BD1E994) + names[power:]
        power *= 2
    out = out ^ (out >> np.uint32(16))
    out *= np.uint32(0x7FEB352D)
    out ^= out >> np.uint32(15)
    out *= np.uint32(0x846CA68B)
    return out ^ (out >> np.uint32(16))


def _spread(names: np.ndarray) -> np.ndarray:
    """Names as hashes that don't follow the order in which anchors are chosen."""
    return mix(names.astype(U) + U(0x632BE59BD9B4E019))


class Crowded:
    """The names of anchors that give way."""

    def __init__(self, names: list[int]):
        self.names = np.array(sorted(names), np.uint32)
        self.hint = np.zeros(1 << 16, bool)
        self.hint[self.names & np.uint32(0xFFFF)] = True

    def at(self, names: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.hint[names & np.uint32(0xFFFF)])
        return maybe[np.isin(names[maybe], self.names)]


class Pieces:
    """The pieces of a chunk of texts: places in ``data`` where each starts, its number of windows, its anchor's distance and name."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, width: int, gram: int, crowded: Crowded):
        self.data = data
        room = np.maximum(np.diff(offsets) - width + 1, 0)
        first = np.cumsum(room) - room
        starts = np.arange(room.sum()) + np.repeat(offsets[:-1] - first, room)
        if not len(starts):
            self.start = self.runs = self.lead = self.text = np.zeros(0, np.int64)
            self.name = np.zeros(0, np.uint32)
            return
        names = gram_names(data, gram)
        rank = names.astype(U)
        rank <<= U(31)
        rank |= np.arange(len(names), dtype=U)
        if len(crowded.names):
            rank[crowded.at(names)] |= U(1 << 63)
        reach, level = 1, rank
        span = width - gram + 1
        while 2 * reach <= span:
            level = np.minimum(level[:-reach], level[reach:])
            reach *= 2
        if reach < span:
            level = np.minimum(level[: len(level) - (span - reach)], level[span - reach :])
        at = (level[starts] & U((1 << 31) - 1)).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = at[1:] != at[:-1]
        head = np.flatnonzero(new)
        self.start = starts[head]
        self.runs = np.diff(np.append(head, len(starts)))
        self.lead = at[head] - self.start
        self.name = names[at[head]]
        self.text = np.searchsorted(offsets, self.start, "right") - 1


_SCHEMA = "bucket int, size long, blob binary"


def _squeeze(raw: bytes) -> bytes:
    return pa.Codec(_CODEC, compression_level=_LEVEL).compress(raw, asbytes=True)


def _pack(bucket: int, columns: list[np.ndarray], marks: list[np.ndarray], data: bytes) -> dict:
    head = np.array([len(columns[0]), len(marks[0])], np.int64)
    raw = b"".join([x.tobytes() for x in (head, *columns, *marks)]) + data
    return {"bucket": bucket, "size": len(raw), "blob": _squeeze(raw)}


_COLUMNS = [np.int64, np.int64, np.int64, np.uint8, np.uint8]
_MARKS = [np.int64, np.int64, np.int64, np.int64]


def _unpack(size: int, blob: bytes) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    raw = pa.decompress(blob, size, _CODEC, asbytes=True)
    n, m = np.frombuffer(raw, np.int64, 2).tolist()
    at, out = 16, []
    for kind, count in [*((k, n) for k in _COLUMNS), *((k, m) for k in _MARKS)]:
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    return out[:5], out[5:], np.frombuffer(raw, np.uint8, -1, at)


def _piece_rows(width: int, gram: int, buckets: int, crowded):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CUT_BYTES):
            data, offsets = buffers(batch.column("text"))
            p = Pieces(data, offsets, width, gram, crowded.value)
            if not len(p.start):
                continue
            order, rid = batch.column("ord").to_numpy()[p.text], batch.column("rid").to_numpy()[p.text]
            place = p.start - offsets[p.text]
            by = np.lexsort((place, order))
            raw, tail = data.tobytes(), width - 1
            ends = (p.start + p.runs + tail).tolist()
            start, kept, later, first = p.start.tolist(), [], [], {}
            parts = [b""] * len(start)
            o, q = order.tolist(), place.tolist()
            for k in by.tolist():
                piece = raw[start[k] : ends[k]]
                one = first.setdefault(piece, k)
                # A row that repeats another one takes the same places and stays beside it.
                if one == k or (o[k], q[k]) == (o[one], q[one]):
                    kept.append(k)
                    parts[k] = piece
                else:
                    later.append(k)
            kept, later = np.array(kept, np.int64), np.array(later, np.int64)
            bucket = (_spread(p.name) % U(buckets)).astype(np.int64)
            kept = kept[np.argsort(bucket[kept], kind="stable")]
            cut = np.flatnonzero(np.diff(bucket[kept], prepend=-1))
            # Known marks travel with the first collection of the chunk.
            known = [order[later], rid[later], place[later], (place + p.runs + tail)[later]]
            out = []
            for number, (a, b) in enumerate(zip(cut.tolist(), [*cut[1:].tolist(), len(kept)], strict=True)):
                k = kept[a:b]
                columns = [order[k], rid[k], place[k], p.runs[k].astype(np.uint8), p.lead[k].astype(np.uint8)]
                marks = known if number == 0 else [x[:0] for x in known]
                out.append(_pack(int(bucket[k[0]]), columns, marks, b"".join([parts[x] for x in k.tolist()])))
            yield pa.RecordBatch.from_pylist(out, pa.schema([("bucket", pa.int32()), ("size", pa.int64()), ("blob", pa.binary())]))

    return rows


def _crowded_rows(width: int, gram: int):
    none = Crowded([])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", CUT_BYTES):
            p = Pieces(*buffers(batch.column("text")), width, gram, none)
            raw = p.data.tobytes()
            ends = p.start + p.runs + width - 1
            names, number, count = np.unique(p.name, return_inverse=True, return_counts=True)
            often = np.flatnonzero(count[number] >= CROWDED)
            distinct = {(n, raw[a:b]) for n, a, b in zip(p.name[often].tolist(), p.start[often].tolist(), ends[often].tolist(), strict=True)}
            names, count = np.unique(np.array([n for n, _ in distinct], np.int64), return_counts=True)
            some = count >= CROWDED
            yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(count[some])], ["name", "n"])

    return rows


def _range_minima(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The minimum of values[lo : hi + 1] for each range."""
    size = hi - lo + 1
    level = np.frexp(size.astype(np.float64))[1] - 1
    out = np.empty(len(lo), values.dtype)
    row = values
    for k in range(int(level.max(initial=-1)) + 1):
        if k:
            half = 1 << (k - 1)
            row = np.minimum(row[:-half], row[half:])
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << k) + 1])
    return out


def late_windows(data: np.ndarray, runs: np.ndarray, lead: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """For each piece and each of its windows whether an equal window has a smaller ``place``.

    ``place`` orders the pieces' anchors; pieces of one place do not remove each other.
    """
    runs, lead = runs.astype(np.int64), lead.astype(np.int64)
    size = runs + width - 1
    base = np.cumsum(size) - size + lead
    late = np.zeros((len(runs), width), bool)
    enters = lead - size + 1
    by = np.argsort(enters, kind="stable")
    low = int(enters.min(initial=0))
    high = int(lead.max(initial=-1))
    gate = np.searchsorted(enters[by], np.arange(low, high + 2))
    order, common = np.zeros(0, np.int64), np.zeros(0, np.uint8)
    for column in range(low, high + 1):
        stays = lead[order] >= column
        if not stays.all():
            at = np.flatnonzero(stays)
            if len(at):
                common = np.minimum.reduceat(common[: at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
            order, common = order[at], common[: len(at)]
        new = by[gate[column - low] : gate[column - low + 1]]
        if len(new):
            order = np.concatenate([new, order])
            common = np.concatenate([np.zeros(len(new), np.uint8), common])
            if len(common) > len(new):
                common[len(new)] = 0
        if not len(order):
            continue
        transform = data[base[order] - column]
        deal = np.argsort(transform, kind="stable")
        order, symbols = order[deal], transform[deal]
        grown = np.zeros(len(order), np.uint8)
        same = np.flatnonzero(symbols[1:] == symbols[:-1]) + 1
        if len(same):
            least = _range_minima(common, deal[same - 1] + 1, deal[same])
            grown[same] = np.minimum(least, width - 1) + 1
        common = grown
        equal = common >= width
        if not equal.any():
            continue
        head = np.zeros(len(order), bool)
        head[:-1] = equal[1:] & ~equal[:-1]
        member = np.flatnonzero(equal | head)
        group = head[member]
        at = place[order[member]]
        first = np.minimum.reduceat(at, np.flatnonzero(group))[np.cumsum(group) - 1]
        gone = order[member[at > first]]
        late[gone, lead[gone] - column] = True
    return late


def _anchored_twice(data: np.ndarray, runs: np.ndarray, lead: np.ndarray, width: int, gram: int) -> np.ndarray:
    """The pieces whose anchor another piece has, too."""
    size = runs.astype(np.int64) + width - 1
    at = np.cumsum(size) - size + lead
    name = np.zeros(len(at), U)
    for k in range(gram):
        name = mix(name + data[at + k].astype(U) + U(1))
    _, back, count = np.unique(name, return_inverse=True, return_counts=True)
    return np.flatnonzero(count[back] > 1)


def _marks(pieces: list, width: int, gram: int) -> Iterator[pa.RecordBatch]:
    columns = [np.concatenate([p[0][k] for p in pieces]) for k in range(5)]
    known = [np.concatenate([p[1][k] for p in pieces]) for k in range(4)]
    data = np.concatenate([p[2] for p in pieces])
    pieces.clear()
    yield _mark_batch(*known)
    keep = _anchored_twice(data, columns[3], columns[4], width, gram)
    if not len(keep):
        return
    size = columns[3].astype(np.int64) + width - 1
    mask = np.zeros(len(size), bool)
    mask[keep] = True
    data = data[np.repeat(mask, size)]
    order, rid, start, runs, lead = (c[keep] for c in columns)
    anchor = start + lead
    by = np.lexsort((anchor, order))
    new = np.ones(len(by), bool)
    new[1:] = (order[by][1:] != order[by][:-1]) | (anchor[by][1:] != anchor[by][:-1])
    place = np.empty(len(by), np.int64)
    place[by] = np.cumsum(new)
    late = late_windows(data, runs, lead, place, width)
    edge = np.diff(late.astype(np.int8), axis=1, prepend=0, append=0)
    piece, begin = np.nonzero(edge == 1)
    _, end = np.nonzero(edge == -1)
    yield _mark_batch(order[piece], rid[piece], start[piece] + begin, start[piece] + end + width - 1)


def _mark_batch(order, rid, start, end) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x) for x in (order, rid, start, end)], ["ord", "rid", "start", "end"])


def _mark_rows(width: int, gram: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for bucket, size, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and held:
                    yield from _marks(held, width, gram)
                    held = []
                now = bucket
                held.append(_unpack(size, blob))
        if held:
            yield from _marks(held, width, gram)

    return rows


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's bytes, compressed for the shuffle."""
    for batch in chunks(batches, "text"):
        data, offsets = buffers(batch.column("text"))
        raw, at = data.tobytes(), offsets.tolist()
        blobs = [_squeeze(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("row"), batch.column("ord"), batch.column("rid"), pa.array(np.diff(offsets)), pa.array(blobs, pa.binary())],
            ["row", "ord", "rid", "n_bytes", "blob"],
        )


def _cut(raw: bytes, starts: list[int], ends: list[int]) -> tuple[bytes, int]:
    """What no range covers, and the number of maximal covered runs."""
    out, spans, reach, last = [], 0, 0, -1
    for a, b in sorted(zip(starts, ends, strict=True)):
        if a > reach or last < 0:
            out.append(raw[reach:a])
            spans += 1
        reach, last = max(reach, b), a
    return b"".join([*out, raw[reach:]]), spans


def _kept_rows(digest: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sizes = batch.column("n_bytes").to_pylist()
                removed, spans, kept = [], [], []
                for n, blob, ranges in zip(sizes, batch.column("blob").to_pylist(), batch.column("ranges").to_pylist(), strict=True):
                    raw = pa.decompress(blob, n, _CODEC, asbytes=True) if n else b""
                    ranges = ranges or []
                    rest, number = _cut(raw, [r["start"] for r in ranges], [r["end"] for r in ranges]) if ranges else (raw, 0)
                    removed.append(n - len(rest))
                    spans.append(number)
                    kept.append(hashlib.sha256(rest).hexdigest() if digest else rest)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row"), batch.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                     pa.array(kept, pa.string() if digest else pa.binary())],
                    ["row", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    return rows


def crowded_anchors(texts: DataFrame, width: int, gram: int) -> Crowded:
    """The anchors that very many different pieces share, counted over all texts; at most ``MOST_CROWDED``.

    They only decide which of its anchors a window takes, never whether it is compared.
    """
    counted = texts.select("text").mapInArrow(_crowded_rows(width, gram), "name long, n long")
    top = counted.groupBy("name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "name").limit(MOST_CROWDED)
    return Crowded([r.name for r in top.collect()])


def remove_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """Every row of ``docs`` without the bytes that an equal string of ``width`` bytes with an earlier start covers.

    Returns ``doc_id, n_bytes, n_removed, n_spans`` (maximal removed runs) and the remaining bytes as
    ``kept``, or with ``digest`` only their SHA-256 as ``kept_sha256``. Strings are judged on the
    input, and none crosses texts. Defined cases: a null text has no bytes; a null ``doc_id``
    comes before all others; rows that share a ``doc_id`` count as one place, so repeated rows
    do not remove each other; other columns are ignored; an empty table gives an empty result.
    """
    if not gram <= width <= 255:
        raise ValueError("an anchor must fit into a window of at most 255 bytes")
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").alias("row"), row_order().alias("ord"), F.xxhash64("doc_id", "text").alias("rid"), "text")
    total = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(parts, total // COLLECTION_BYTES)
    crowded = spark.sparkContext.broadcast(crowded_anchors(texts, width, gram))
    pieces = texts.select("ord", "rid", "text").mapInArrow(_piece_rows(width, gram, buckets, crowded), _SCHEMA)
    dealt = pieces.repartitionById(parts, F.col("bucket") % parts).sortWithinPartitions("bucket")
    marks = dealt.mapInArrow(_mark_rows(width, gram), "ord long, rid long, start long, end long")
    ranges = marks.groupBy("ord", "rid").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    blobs = texts.mapInArrow(_squeezed, f"row {id_type}, ord long, rid long, n_bytes long, blob binary")
    out = blobs.join(ranges, ["ord", "rid"], "left").select("row", "n_bytes", "blob", "ranges")
    kind = f"row {id_type}, n_bytes long, n_removed long, n_spans long, kept {'string' if digest else 'binary'}"
    cleaned = out.mapInArrow(_kept_rows(digest), kind).withColumnRenamed("row", "doc_id")
    return cleaned.withColumnRenamed("kept", "kept_sha256") if digest else cleaned
