"""Hierarchical packing of token sequences into windows of several lengths."""

from __future__ import annotations

import base64
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from uptake.llm.common import chunks

TIERS = (2048, 1024, 512, 256)
END = 1
#: A step's sequences hold about so many tokens together.
STEP_TOKENS = 1 << 16
#: Texts are packed together within one chunk of a task's input of this many bytes.
PACK_BYTES = 16 << 20
#: Encoded stretches of text that a task remembers; beyond, it encodes anew.
REMEMBERED = 300_000
_SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of a byte-level BPE vocabulary, as little-endian unsigned 32-bit values.

    The pre-tokenizer never joins across a single space, so a text can be cut before each one, and
    the pieces, most of which are frequent words, are remembered. Texts with two spaces together or the special token go whole through the
    reference tokenizer.
    """

    def __init__(self, json_file: str, rank_file: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_file)
        with open(rank_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.part = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        if "  " in text or _SPECIAL in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        known = self.known
        head, *rest = text.split(" ")
        try:
            return self._new(head) + b"".join([known[x] for x in rest])
        except KeyError:
            out = [self._new(head)]
            for x in rest:
                if (got := known.get(x)) is None:
                    got = self._new(" " + x)
                    if len(known) < REMEMBERED:
                        known[x] = got
                out.append(got)
            return b"".join(out)

    def _new(self, piece: str) -> bytes:
        return np.array(self.part.encode_ordinary(piece), "<u4").tobytes()


@cache
def encoder(json_file: str, rank_file: str) -> Encoder:
    return Encoder(json_file, rank_file)


class Pool:
    """Pieces by length, the latest first."""

    def __init__(self):
        self.by: defaultdict[int, list] = defaultdict(list)
        self.mask = 0

    def add(self, piece: tuple[int, int, int]) -> None:
        n = piece[2]
        self.by[n].append(piece)
        self.mask |= 1 << n

    def _take(self, n: int) -> tuple[int, int, int]:
        piece = self.by[n].pop()
        if not self.by[n]:
            self.mask &= ~(1 << n)
        return piece

    def longest(self, most: int) -> tuple[int, int, int] | None:
        """Takes the longest piece of at most ``most`` tokens."""
        fits = self.mask & ((1 << (most + 1)) - 1)
        return self._take(fits.bit_length() - 1) if fits else None

    def shortest(self) -> tuple[int, int, int] | None:
        return self._take((self.mask & -self.mask).bit_length() - 1) if self.mask else None


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Windows as (context size, pieces); a piece is (document, start, length). All tokens are placed once.

    A document longer than the largest tier fills windows of its own. What is left goes to the smallest tier that holds
    it. From the longest tier down, each document opens a window; the longest pieces that fit,
    from any shorter tier, fill its gap, and where none fits, the shortest piece left is cut. So windows are full; tokens
    that end up alone at the very end are split into windows of powers of two.
    """
    top = tiers[0]
    pool, out = Pool(), []
    for document, n in enumerate(lengths):
        full = n - n % top
        out += [(top, [(document, s, top)]) for s in range(0, full, top)]
        if n % top:
            pool.add((document, full, n % top))
    for size in tiers:
        shorter = next((t for t in tiers if t < size), 0)
        while pool.mask.bit_length() - 1 > shorter or (shorter == 0 and pool.mask):
            window, gap = [pool.longest(size)], size
            gap -= window[0][2]
            while gap and pool.mask:
                piece = pool.longest(gap)
                if piece is None:
                    document, start, n = pool.shortest()
                    piece = (document, start, gap)
                    pool.add((document, start + gap, n - gap))
                window.append(piece)
                gap -= piece[2]
            out += [(size, window)] if gap == 0 else _powers(window)
    return out


def _powers(pieces: list[tuple[int, int, int]]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The pieces cut into windows whose lengths are the powers of two in their sum."""
    left, out = sum(p[2] for p in pieces), []
    todo = list(reversed(pieces))
    while left:
        size = 1 << (left.bit_length() - 1)
        window, room = [], size
        while room:
            document, start, n = todo.pop()
            window.append((document, start, min(n, room)))
            if n > room:
                todo.append((document, start + room, n - room))
            room -= min(n, room)
        out.append((size, window))
        left -= size
    return out


_FIELDS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, context int, step_group long"


def _packed(json_file: str, rank_file: str, pack_bytes: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(json_file, rank_file)
        # Sequences are numbered within the task; the task's number makes them unique.
        sequence = step = TaskContext.get().partitionId() << 33
        for batch in chunks(batches, "text", pack_bytes):
            ids = [coder.ids(t or "") + END.to_bytes(4, "little") for t in batch.column("text").to_pylist()]
            lengths = [len(x) // 4 for x in ids]
            out = []
            windows = pack(lengths)
            groups = step_groups([size for size, _ in windows])
            for (size, window), group in zip(windows, groups, strict=True):
                offset = 0
                for document, start, n in window:
                    crc = zlib.crc32(memoryview(ids[document])[4 * start : 4 * (start + n)])
                    out.append((document, start, n, crc, lengths[document], sequence, offset, size, step + group))
                    offset += n
                sequence += 1
            step += max(groups, default=-1) + 1
            columns = list(zip(*out, strict=True))
            names = [x.split()[0] for x in _FIELDS.split(", ")]
            arrays = [pa.array(c, pa.int32() if n == "context" else pa.int64()) for n, c in zip(names, columns[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("row").take(pa.array(columns[0])), *arrays], ["row", *names])

    return rows


def step_groups(sizes: list[int], tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each window, so that groups hold the same context size and about ``tokens`` tokens each."""
    seen: dict[int, int] = defaultdict(int)
    numbers: dict[tuple[int, int], int] = {}
    out = []
    for size in sizes:
        out.append(numbers.setdefault((size, seen[size] // tokens), len(numbers)))
        seen[size] += size
    return out


def vocabulary_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def packed(docs: DataFrame, files: tuple[str, str] | None = None, pack_bytes: int = PACK_BYTES) -> DataFrame:
    """Every piece of every row: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, context, step_group``.

    A row's ids are those of its text and then id 1. Every task packs its own input, so nothing is shuffled; sequence
    numbers are unique but have gaps between tasks. Defined cases: a null or empty text is the end id alone; repeated rows are packed
    each for itself; null ids stay null; other columns are ignored. ``files`` are the vocabulary's paths.
    """
    json_file, rank_file = files or vocabulary_files()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = docs.selectExpr("doc_id as row", "text").mapInArrow(_packed(json_file, rank_file, pack_bytes), f"row {id_type}, {_FIELDS}")
    return out.withColumnRenamed("row", "doc_id")
