"""Words and word hashes of many texts at once, as numpy passes over Arrow's string buffers.

No text is decoded and no Python loop runs per word.  A slice holds whole texts of about SLICE_BYTES bytes (a longer text
is a slice of its own), so memory follows the longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = np.ones(1, _U)
_inverses = np.ones(1, _U)


def byte_class(ranges: list[tuple[int, int]], inside: bool) -> np.ndarray:
    """A table of 256 flags: whether a byte belongs to a word; ``ranges`` (inclusive) are word bytes or, if not inside, separators."""
    table = np.full(256, not inside)
    for low, high in ranges:
        table[low : high + 1] = inside
    return table


#: Words are runs of bytes other than ASCII white space.
SPACED = byte_class([(0x20, 0x20), (0x09, 0x0D)], inside=False)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _byte_values() -> np.ndarray:
    """A fixed random 64-bit value for each byte; capitals A-Z share those of a-z."""
    return mix(np.arange(1, 257, dtype=_U) * _U(0xD1342543DE82EF95))[LOWER]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shift, multiply, shift, multiply, shift)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


_VALUES = _byte_values()


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 2 * SLICE_BYTES)
        steps = np.full(size, _U(_BASE)), np.full(size, _U(_INVERSE))
        for s in steps:
            s[0] = 1
        _powers, _inverses = (np.multiply.accumulate(s) for s in steps)
    return _powers, _inverses


@dataclass
class Slice:
    """Some whole rows: ``first`` is the number of the first, text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Start and end bytes of all words; those of text ``i`` are numbers ``of[i]`` to ``of[i + 1]``."""

    starts: np.ndarray
    ends: np.ndarray
    of: np.ndarray


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Whole rows of a string or binary column, about ``limit`` bytes at a time; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, n)
        yield Slice(first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def words(part: Slice, table: np.ndarray = SPACED) -> Words:
    """All words of a slice; a word never crosses the border of two texts."""
    inside = table[part.data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[1:] = inside[:-1]
        after[:-1] = inside[1:]
        borders = part.offsets[:-1]
        before[borders[borders < len(inside)]] = False
        ends = part.offsets[1:]
        after[ends[ends > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    return Words(starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, part.offsets))


def word_hashes(part: Slice, w: Words) -> np.ndarray:
    """A 64-bit hash of each word's bytes, with A-Z lower-cased: differences of prefix sums of a polynomial, mixed."""
    powers, inverses = _tables(len(part.data) + 1)
    sums = np.zeros(len(part.data) + 1, _U)
    np.cumsum(_VALUES[part.data] * powers[: len(part.data)], out=sums[1:])
    h = (sums[w.ends] - sums[w.starts]) * inverses[w.starts]
    return mix(h + (w.ends - w.starts).astype(_U))


def shingle_hashes(h: np.ndarray, w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of ``size`` words, or of its whole sequence if it has fewer; and where each text's runs begin."""
    counts = np.diff(w.of)
    runs = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(runs)))
    long = counts >= size
    out = np.zeros(begin[-1], _U)
    if long.any():
        every = np.zeros(max(0, len(h) - size + 1), _U)
        for k in range(size):
            every += h[k : len(h) - size + 1 + k] * _U((_BASE * (2 * k + 3) ** 5) & (2**64 - 1) | 1)
        first = np.repeat(w.of[:-1][long], runs[long])
        step = np.arange(len(first)) - np.repeat(np.cumsum(runs[long]) - runs[long], runs[long])
        place = np.repeat(begin[:-1][long], runs[long]) + step
        out[place] = every[first + step]
    for i in np.flatnonzero((counts > 0) & ~long):
        total = int(counts[i])
        for x in h[w.of[i] : w.of[i + 1]].tolist():
            total = (total * 0x100000001B3 ^ x) * _BASE & (2**64 - 1)
        out[begin[i]] = total
    return mix(out), begin
