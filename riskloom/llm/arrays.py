"""Vectorised text helpers for the Arrow batches of this subpackage.

Texts are worked on as one byte array and the offsets of its documents, never one by one. Hashes are
64-bit: a polynomial over random byte values, so that the hash of any stretch comes from two prefix
sums, followed by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# A working slice. Most helpers need about ten arrays of eight bytes for each byte of it.
SLICE_BYTES = 1 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * BASE) | np.uint64(1)
_POWERS = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64; they are kept for the next batch, twice as many as were needed at most."""
    if len(_POWERS["up"]) < n:
        size = 1 << n.bit_length()
        odd = 0x5851F42D4C957F2D
        for name, value in (("up", odd), ("down", pow(odd, -1, 1 << 64))):
            table = np.full(size, value, np.uint64)
            table[0] = 1
            np.multiply.accumulate(table, out=table)
            _POWERS[name] = table
    return _POWERS["up"][:n], _POWERS["down"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUE[data] * up[:-1], out=sums[1:])
    return sums


def stretch_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches [start, end): equal bytes give equal hashes wherever they stand."""
    _, down = _powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and the offsets of its values. Nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(offsets) else np.zeros(0, np.uint8)
    return data, offsets.astype(np.int64) - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about ``limit`` bytes of a text column, and one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, upto - at)
            at = upto
    pa.default_memory_pool().release_unused()  # workers live on: the next stage should not carry this one's buffers


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and, for each document and the end, the first word number. Words are runs of non-space bytes."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` tokens, given the tokens' hashes."""
    if len(tokens) < size:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(tokens) - size + 1, np.uint64)
    factor = 1
    for i in range(size):
        total += tokens[i : len(tokens) - size + 1 + i] * np.uint64(factor)
        factor = factor * 0x2545F4914F6CDD1D % (1 << 64)
    return mix(total)


def doc_numbers(bounds: np.ndarray) -> np.ndarray:
    """For each element, the number of the document between whose bounds it lies."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
