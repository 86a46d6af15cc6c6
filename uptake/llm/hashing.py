"""Words and hashes of many texts at once, as numpy arrays inside a task."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = U(0x9E3779B97F4A7C15)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))
_BITS = ((np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1).astype(np.float64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=U)


class Sums:
    """Polynomial hashes of every slice of ``values``, from prefix sums modulo 2^64."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.total = np.zeros(n + 1, U)
        np.cumsum(values * powers(_BASE, n), dtype=U, out=self.total[1:])
        self.back = powers(_INVERSE, n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * self.back[starts] + (ends - starts).astype(U))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and each row's offsets in them; a null is empty."""
    column = pa.compute.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]] if len(offsets) else data, offsets - offsets[:1]


class Words:
    """The maximal runs of other than ASCII white space in each text.

    ``first[k]`` to ``first[k + 1]`` are the words of text k; ``hash`` has each word's 64-bit hash.
    """

    def __init__(self, column: pa.Array, breaks: np.ndarray = _SPACE, fold: np.ndarray | None = None):
        data, offsets = buffers(column)
        gap = np.ones(len(data) + 2, bool)
        gap[1:-1] = breaks[data]
        # A text's first byte begins a word even if the text before it ends in one.
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        inside = ~gap[1:-1]
        self.starts = np.flatnonzero(inside & (gap[:-2] | edge[:-1]))
        self.ends = np.flatnonzero(inside & (gap[2:] | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.text = np.repeat(np.arange(len(column)), self.counts)
        letters = data if fold is None else fold[data]
        self.hash = Sums(letters.astype(U) + U(1)).of(self.starts, self.ends)

    def __len__(self) -> int:
        return len(self.starts)


def bit_votes(hashes: np.ndarray, text: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """For each of ``n`` texts and each of 64 bits, the weight of its hashes that have the bit set."""
    at = text.astype(np.int64) * 256
    out = np.zeros((n, 64))
    for k in range(8):
        byte = ((hashes >> U(8 * k)) & U(255)).astype(np.int64)
        table = np.bincount(at + byte, weights, minlength=n * 256).reshape(n, 256)
        out[:, 8 * k : 8 * k + 8] = table @ _BITS
    return out


def pack_bits(on: np.ndarray) -> np.ndarray:
    """Rows of 64 booleans, lowest bit first, as unsigned 64-bit values."""
    return np.packbits(on, axis=1, bitorder="little").view("<u8").ravel()
