"""Word shingles of whole batches of texts as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_RANDOM = np.random.Generator(np.random.PCG64(20_240_601))
#: A random value for each place in a word (of 64, then anew with a factor) and byte.
BYTE_VALUES = _RANDOM.integers(1, 1 << 64, (64, 256), dtype=U)
BLOCK_FACTOR = U(0x9E3779B97F4A7C15)
PLACE_FACTORS = _RANDOM.integers(0, 1 << 63, 64, dtype=U) * U(2) + U(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
PART_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit, by shifts and odd factors."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and ends; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    return data, offsets


def parts(offsets: np.ndarray, limit: int = PART_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes, so that working arrays stay small."""
    first = 0
    while first < len(offsets) - 1:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word, A-Z lowered, and the number of the first word of each text."""
    low = LOWER[data[offsets[0]:offsets[-1]]]
    bounds = offsets - offsets[0]
    inside = ~SPACE[low]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = bounds[:-1][bounds[:-1] < bounds[1:]]
    begins[first] = inside[first]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.zeros(0, U), np.zeros(len(bounds), np.int64)
    place = np.arange(starts[0], len(low)) - np.repeat(starts, np.diff(starts, append=len(low)))
    tail = low[starts[0]:]
    value = BYTE_VALUES[place & 63, tail]
    block = place >> 6
    if block.any():
        factors = np.cumprod(np.full(int(block.max()) + 1, BLOCK_FACTOR), dtype=U)
        value = np.where(block > 0, value * factors[block], value)
    value[~inside[starts[0]:]] = 0
    return mix(np.add.reduceat(value, starts - starts[0])), np.searchsorted(starts, bounds)


def shingle_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of ``size`` words in a row.

    A text with fewer words has its whole sequence as the only one; one without words has none.
    """
    data, offsets = text_bytes(column)
    for first, last in parts(offsets):
        words, at = word_hashes(data, offsets[first:last + 1])
        count = len(words) - size + 1
        joined = np.zeros(max(count, 0), U)
        for k in range(size if count > 0 else 0):
            joined += words[k:k + count] * PLACE_FACTORS[k]
        joined = mix(joined)
        for begin, end in zip(at, at[1:], strict=False):
            if end - begin >= size:
                yield np.unique(joined[begin:end - size + 1])
            elif end > begin:
                short = words[begin:end] * PLACE_FACTORS[:end - begin]
                yield mix(short.sum(keepdims=True, dtype=U) + U(int(end - begin)))
            else:
                yield np.zeros(0, U)
