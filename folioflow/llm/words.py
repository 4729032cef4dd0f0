"""Vectorised views of text columns inside Arrow batches: bytes, words, word n-grams.

Words are the runs of bytes other than space and \\t-\\r. All hashes are functions of the
bytes alone, so every task and every run computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64): spreads every input bit over the output."""
    x = x + U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def numbers(seed: int, count: int) -> np.ndarray:
    """``count`` fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(count, dtype=U64) + U64(seed << 32))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 row bounds; NULL counts as empty."""
    column = column.fill_null("") if column.null_count else column
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, bounds, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(bounds, width)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES, most_rows: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``limit`` bytes, of ``most_rows`` rows at most, with their bytes and bounds; a longer text stands alone."""
    data, bounds = text_bytes(column)
    row, rows = 0, len(bounds) - 1
    while row < rows:
        stop = max(row + 1, min(row + most_rows, int(np.searchsorted(bounds, bounds[row] + limit, "right")) - 1))
        yield row, stop, data[bounds[row]:bounds[stop]], bounds[row:stop + 1] - bounds[row]
        row = stop


class WordHasher:
    """Positions and 64-bit hashes of the words of many texts at once.

    A word's hash is a polynomial in its bytes' random values, taken from prefix sums
    (mod 2^64, odd base, so powers can be divided out) and then mixed.
    """

    BASE = 0x5851F42D4C957F2D

    def __init__(self, fold_case: bool = False, letters_only: bool = False) -> None:
        byte = np.arange(256)
        gap = (byte == 32) | ((byte >= 9) & (byte <= 13))
        if letters_only:
            gap = (byte < 128) & np.array([not chr(b).isalnum() for b in byte])
        lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte) if fold_case else byte
        self.inside = ~gap
        self.value = numbers(1, 256)[lower]
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        inverse = pow(self.BASE, -1, 1 << 64)
        self.power = np.concatenate([[U64(1)], np.full(size, self.BASE, U64)]).cumprod(dtype=U64)
        self.inverse = np.concatenate([[U64(1)], np.full(size, inverse, U64)]).cumprod(dtype=U64)

    def spans(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte and end of each word, and the n + 1 word bounds of the texts."""
        inside = self.inside[data]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        cut = bounds[:-1][bounds[:-1] < len(data)]
        before[cut] = False
        starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:] & before[1:]
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, bounds)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.power):
            self._grow(len(data) * 5 // 4)
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(self.value[data] * self.power[:len(data)], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * self.inverse[starts])


def shingles(hashes: np.ndarray, bounds: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word runs, repeats included, and the n + 1 bounds of the texts.

    A text of fewer words is one shingle of all its words; a text without words has none.
    """
    count = np.diff(bounds)
    own = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    out = np.concatenate([[0], np.cumsum(own)])
    at = np.arange(out[-1]) + np.repeat(bounds[:-1] - out[:-1], own)
    room = np.repeat(bounds[1:], own) - at
    padded = np.concatenate([hashes, np.zeros(size, U64)])
    total = np.zeros(out[-1], U64)
    short = room < size
    for k, factor in enumerate(numbers(2, size) | U64(1)):
        term = padded[at + k] * factor
        if short.any():
            term[short & (room <= k)] = 0
        total += term
    return mix(total), out
