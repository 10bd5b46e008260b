"""Text columns as flat numpy arrays: the shared ground of the vectorised operators.

A block of documents becomes one byte array with document offsets. Rolling hashes, word hashes
and window hashes are prefix sums over that array modulo 2**64, so the work per byte does not
depend on the number of documents, and a block never holds more than a fixed number of bytes
unless a single document is longer.
"""

from __future__ import annotations

import ctypes
from functools import lru_cache

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 5  # odd, and 5 modulo 8: its powers have the longest period
U64 = np.uint64


def mix(x):
    """A bijective scramble of 64-bit integers (two multiply-xorshift rounds)."""
    x = np.asarray(x, U64)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


POWER_BITS = 20  # of the table of powers; a worker holds two of them, 8 MB each, however long its texts
POWER_SIZE = 1 << POWER_BITS


@lru_cache(1)
def _powers():
    """Powers of BASE and of its inverse below ``POWER_SIZE``, and both to the power ``POWER_SIZE``."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        steps = np.full(POWER_SIZE, base % (1 << 64), U64)
        steps[0] = 1
        out.append((np.cumprod(steps, dtype=U64), pow(base, POWER_SIZE, 1 << 64)))
    return out


def powers():
    """The first ``POWER_SIZE`` powers of BASE and of its inverse."""
    return [table for table, _ in _powers()]


def _high(step, count):
    """Powers 0, 1, 2 ... of one of the two factors."""
    return np.cumprod(np.array([1, *[step] * (count - 1)], U64), dtype=U64)


BYTE_CODES = mix(np.arange(1, 257, dtype=U64))


class Rolling:
    """Hashes of any slice of a sequence of 64-bit codes, equal for equal slices."""

    def __init__(self, codes):
        (power, step), (self.inverse, back) = _powers()
        parts = len(codes) // POWER_SIZE + 1
        self.back = _high(back, parts)
        self.sums = np.empty(len(codes) + 1, U64)
        self.sums[0] = total = U64(0)
        for number, factor in enumerate(_high(step, parts)):
            part = codes[number * POWER_SIZE : (number + 1) * POWER_SIZE]
            found = self.sums[number * POWER_SIZE + 1 : number * POWER_SIZE + 1 + len(part)]
            np.multiply(part, power[: len(part)], out=found)
            np.cumsum(found, out=found)
            found *= factor
            found += total
            total = found[-1] if len(found) else total

    def hashes(self, start, end):
        start, end = np.asarray(start), np.asarray(end)
        back = self.inverse[start & (POWER_SIZE - 1)]
        if len(self.back) > 1:
            back = back * self.back[start >> POWER_BITS]
        return mix((self.sums[end] - self.sums[start]) * back + (end - start).astype(U64))


def release():
    """Hand memory that was freed back to the system, so that a worker's largest block does not stay with it."""
    pa.default_memory_pool().release_unused()
    if trim := _trim():
        trim(0)


@lru_cache(1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return None


def flat(column):
    """Bytes of all values of a string or binary column, and where each value starts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def blocks(batches, column="text", limit=BLOCK_BYTES):
    """Slices of Arrow batches with about ``limit`` bytes of text; a longer text comes alone."""
    for batch in batches:
        _, offsets = flat(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = max(start + 1, end)
            yield batch.slice(start, end - start)
            start = end
    release()


WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[32, *range(9, 14)]] = False


class Words:
    """Words of a block: ``[^\\x20\\x09-\\x0D]+`` within each document, unchanged."""

    inside = WORD_BYTES

    def __init__(self, column):
        data, self.offsets = flat(column)
        inside = self.inside[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[self.offsets] = True
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (edge[:-1] | ~before))
        self.ends = np.flatnonzero(inside & (edge[1:] | ~after)) + 1
        self.codes = Rolling(BYTE_CODES[data]).hashes(self.starts, self.ends)
        # first word of each document, and behind the last
        self.firsts = np.searchsorted(self.starts, self.offsets)

    def counts(self):
        return np.diff(self.firsts)


def lists(values, counts):
    """An Arrow list column of ``counts`` values a row, taken from a flat array."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def signed(hashes):
    """64-bit hashes as Spark's long."""
    return pa.array(np.asarray(hashes, U64).view(np.int64))
