"""Words and hashes of many texts at once, as numpy arrays over Arrow string columns.

A block is a run of consecutive rows with a bounded number of text bytes (a single longer text is a block
of its own). Within a block words are found and hashed without a Python loop over rows or words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
PART = 1 << 16
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_BASE_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: a bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


# The twelve ASCII blanks of the word pattern are six: space, tab, line feed, vertical tab, form feed, return.
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
# Letters and digits of ASCII, and every byte of a longer UTF-8 sequence.
ALNUM = np.zeros(256, bool)
ALNUM[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = True


def _byte_codes(fold: bool) -> np.ndarray:
    values = np.arange(256, dtype=np.uint64)
    if fold:
        values[65:91] += _U(32)
    return mix(values + _U(0x51ED270B9F1D2C33))


_CODES = {fold: _byte_codes(fold) for fold in (False, True)}
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, 0 to n - 1."""
    up, down = np.full(n, _BASE), np.full(n, _BASE_INVERSE)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _some_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n - 1).bit_length() if n > 1 else 0)
    up, down = _powers(size)
    return up[:n], down[:n]


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None) -> np.ndarray:
    """Hash of codes[start:end] for each pair; equal sequences have equal hashes wherever they stand.

    Starts ascend. Ranges are taken in parts that begin within ``PART`` codes of each other, as every code needs some
    forty bytes of sums and powers meanwhile. With ``table``, the codes are what it holds at them.
    """
    out = np.zeros(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        low = starts[a]
        b = int(np.searchsorted(starts, low + PART, "left"))
        begin, end = starts[a:b] - low, ends[a:b] - low
        part = codes[low : low + end.max()]
        if table is not None:
            part = table[part]
        up, down = _some_powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        out[a:b] = mix((sums[end] - sums[begin]) * down[begin] + (end - begin).astype(np.uint64) * _U(0xD1B54A32D192ED03))
        a = b
    return out


@dataclass
class Block:
    """Rows first to last-1 of a batch: their bytes, and each text's offsets into them."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a string column into blocks; null counts as the empty text."""
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        width = np.int64
    else:
        column, width = column.cast(pa.string()), np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), first + 50_000, len(column))
        yield Block(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Words of a block: byte ranges, the row each belongs to, and where each row's words begin."""

    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray
    first: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)


def words(block: Block, separator: np.ndarray = BLANK) -> Words:
    """Maximal runs of bytes that are not separators, within each text."""
    inside = ~separator[block.data]
    n = len(inside)
    edges = block.offsets[(block.offsets > 0) & (block.offsets < n)]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[edges] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, block.offsets)
    rows = np.repeat(np.arange(len(first) - 1, dtype=np.int32), np.diff(first))
    return Words(starts, ends, rows, first)


def word_hashes(block: Block, found: Words, fold: bool) -> np.ndarray:
    """Hash of each word; ``fold`` takes A-Z as a-z."""
    return range_hashes(block.data, found.starts, found.ends, _CODES[fold])


def row_sets(hashes: np.ndarray, found: Words, width: int) -> list[np.ndarray]:
    """Sorted distinct shingles of ``width`` words of each row; a shorter row is one shingle of all its words."""
    count = found.count()
    at = np.arange(len(hashes))
    stop = found.first[1:][found.rows] if len(hashes) else at
    whole = (count[found.rows] < width) & (at == found.first[:-1][found.rows]) if len(hashes) else at > 0
    taken = np.flatnonzero((at + width <= stop) | whole)
    ends = np.minimum(taken + width, stop[taken])
    keys = range_hashes(hashes, taken, ends)
    cuts = np.searchsorted(taken, found.first)
    return [np.unique(keys[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
