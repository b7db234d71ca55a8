"""Words of whole texts as numpy arrays, computed on the bytes of Arrow columns.

A word's hash is a polynomial over its bytes modulo 2^64, taken from prefix sums, so a batch
needs no Python loop over words. Texts are handled in slices of about a megabyte: memory is
bounded by that and by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit values."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * np.uint64(_BASE))


_BYTE = seeded(256, 7)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]

_byte = np.arange(256)
SPACED = ~((_byte == 0x20) | ((_byte >= 0x09) & (_byte <= 0x0D)))  # bytes of [^\x20\x09-\x0D]
ALNUM = ((_byte >= 48) & (_byte <= 57)) | ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)


def _power(kind: str, n: int) -> np.ndarray:
    table = _powers[kind]
    if len(table) < n:
        step = _BASE if kind == "up" else pow(_BASE, -1, 1 << 64)
        steps = np.full(max(n, 1 << 16), step, np.uint64)
        steps[0] = 1
        table = _powers[kind] = np.multiply.accumulate(steps)
    return table[:n]


@dataclass
class Words:
    """Words of the texts of one slice, one after the other; text r has words rows[r] to rows[r + 1]."""

    data: np.ndarray  # bytes of the slice
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    rows: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.rows)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets into them) of runs of texts; null counts as empty."""
    if len(column) == 0:
        return
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        own = offsets[low : high + 1]
        yield low, high, data[own[0] : own[-1]], own - own[0]
        low = high


def split_words(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, fold: bool, inside: np.ndarray | None = None) -> Words:
    """Runs of bytes marked in `letters` (or `inside`, by position); A-Z hash as a-z if `fold`."""
    n = len(data)
    inside = letters[data] if inside is None else inside
    before, after = np.ones(n, bool), np.ones(n, bool)
    before[1:], after[:-1] = ~inside[:-1], ~inside[1:]
    before[offsets[:-1][offsets[:-1] < n]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    start, end = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    values = (_FOLDED if fold else _BYTE)[data]
    values *= _power("up", n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(values, out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * _power("down", n + 1)[start])
    return Words(data, start, end, hashes, np.searchsorted(start, offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes start[i]..end[i] of one slice; equal bytes have equal hashes in every slice."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("up", n), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power("down", n + 1)[start] + (end - start).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def windows(words: Words, width: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of `width` words within one text."""
    h = words.hash if hashes is None else hashes
    n = len(h)
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(h * _power("up", n), out=sums[1:])
    first = np.arange(n - width + 1)
    whole = first + width <= np.repeat(words.rows[1:], words.counts)[: len(first)]
    first = first[whole]
    return first, mix((sums[first + width] - sums[first]) * _power("down", n)[first])


def sequences(words: Words, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Hash of the word runs low[i]..high[i], whatever their length."""
    n = len(words.hash)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(words.hash * _power("up", n), out=sums[1:])
    return mix((sums[high] - sums[low]) * _power("down", n + 1)[low] + (high - low).astype(np.uint64) * np.uint64(0x632BE59BD9B4E019))


def longs(x: np.ndarray) -> pa.Array:
    """Unsigned 64-bit values as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
