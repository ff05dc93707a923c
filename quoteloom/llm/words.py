"""Words and word hashes of whole Arrow text columns, with numpy and without a loop over words.

A byte table says which bytes belong to words (0: they do not) and folds A-Z to a-z. UTF-8 bytes of
other characters are at least 0x80 and stay as they are, so tables over ASCII classes work on bytes.
Hashes have 64 bits; texts come in chunks of a bounded size, a longer text is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C13)  # odd, 3 modulo 8
_rng = np.random.default_rng(20240607)
_BYTE_CODES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP_CODES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)


def byte_table(separators: list[tuple[int, int]]) -> np.ndarray:
    """The table for words of all bytes outside the given inclusive ranges, A-Z folded to a-z."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    for low, high in separators:
        table[low : high + 1] = 0
    return table


#: Words ``[^\x20\x09-\x0D]+``. Byte 0 belongs to words there; it becomes 0xFF, which no UTF-8 text holds.
SPACED = byte_table([(0x20, 0x20), (0x09, 0x0D)])
SPACED[0] = 0xFF
#: Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after folding.
ALPHANUMERIC = byte_table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(size: int) -> np.ndarray:
    global _powers
    if len(_powers) < size:
        grown = np.full(max(size, 2 * len(_powers), 256), _MULTIPLIER)
        grown[0] = 1
        _powers = np.multiply.accumulate(grown)
    return _powers


@dataclass
class Chunk:
    """Words of consecutive rows. ``row`` counts from the chunk's first row, which is ``first``."""

    first: int
    rows: int
    folded: np.ndarray  # bytes by the table
    starts: np.ndarray  # of each word in the chunk's bytes
    ends: np.ndarray
    row: np.ndarray  # of each word
    counts: np.ndarray  # words of each row
    offsets: np.ndarray  # of each row's first word, and the end

    def word_hashes(self) -> np.ndarray:
        lengths = self.ends - self.starts
        if not len(lengths):
            return np.zeros(0, np.uint64)
        inside = self.folded[self.folded != 0]
        begin = np.cumsum(lengths) - lengths
        place = np.arange(len(inside)) - np.repeat(begin, lengths)
        terms = _BYTE_CODES[inside] * _power_table(int(lengths.max()))[place]
        return mix(np.add.reduceat(terms, begin) + lengths.astype(np.uint64) * _STEP_CODES[63])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row; null rows are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), bounds


def chunks(column: pa.Array, table: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The words of a text column, in chunks of whole rows of about ``limit`` bytes."""
    if not len(column):
        return
    data, bounds = text_bytes(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield _split(data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first], table, first)
        first = last


def _split(data: np.ndarray, bounds: np.ndarray, table: np.ndarray, first: int) -> Chunk:
    folded = table[data]
    inside = folded != 0
    rows = len(bounds) - 1
    opens, closes = inside.copy(), inside.copy()
    if len(data):
        edge = np.zeros(len(data) + 1, bool)
        edge[bounds] = True
        opens[1:] &= ~inside[:-1] | edge[1:-1]
        closes[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    row = np.searchsorted(bounds, starts, side="right") - 1
    counts = np.bincount(row, minlength=rows)
    return Chunk(first, rows, folded, starts, ends, row, counts, np.concatenate(([0], np.cumsum(counts))))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of ``n`` consecutive words at each word but the last ``n - 1``, across row borders."""
    size = len(hashes) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(size, n, np.uint64) * _STEP_CODES[62]
    for k in range(n):
        total += hashes[k : k + size] * _STEP_CODES[k]
    return mix(total)


def gram_starts(chunk: Chunk, n: int) -> np.ndarray:
    """Positions at which ``n`` words lie in one row."""
    size = len(chunk.row) - n + 1
    if size <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(chunk.row[:size] == chunk.row[n - 1 :])


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
