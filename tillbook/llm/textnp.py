"""Vectorised text helpers for Arrow batches inside Spark tasks.

A block is a run of neighbouring rows of one Arrow string column, seen as its
UTF-8 bytes plus row offsets, without decoding.  Blocks hold about
``BLOCK_BYTES`` (or one longer row), so a task's memory does not follow the
batch size.  Words follow ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_RNG = np.random.default_rng(20240229)
_BYTE_VALUE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = _BYTE_VALUE.copy()
_LOWERED[65:91] = _BYTE_VALUE[97:123]
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POSITION = _RNG.integers(0, 1 << 63, 5, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


class Block(NamedTuple):
    first: int            # row of the batch
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, one more than rows


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray       # row within the block


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Split a string column into byte blocks; a null row counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if len(column) == 0:
        return
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if large else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield Block(lo, raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
        lo = hi


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public SplitMix constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        factor = _BASE if kind == "up" else _INVERSE
        run = np.full(max(n, BLOCK_BYTES + 1), factor, dtype=np.uint64)
        run[0] = 1
        have = _powers[kind] = np.cumprod(run, dtype=np.uint64)
    return have[:n]


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """64-bit hash of every byte range, independent of where it stands."""
    table = _LOWERED if lower else _BYTE_VALUE
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(table[data] * _power("up", len(data)), out=sums[1:], dtype=np.uint64)
    value = (sums[ends] - sums[starts]) * _power("down", len(data) + 1)[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(block: Block) -> Words:
    space = IS_SPACE[block.data]
    before = np.ones(len(space) + 1, dtype=bool)      # a row starts after a break
    before[1:] = space
    before[block.offsets[:-1]] = True
    after = np.ones(len(space) + 1, dtype=bool)
    after[:-1] = space
    after[block.offsets[1:]] = True
    starts = np.flatnonzero(before[:-1] & ~space)
    ends = np.flatnonzero(after[1:] & ~space) + 1
    return Words(starts, ends, np.searchsorted(block.offsets, starts, side="right") - 1)


def word_hashes(block: Block) -> tuple[np.ndarray, Words]:
    found = words(block)
    return segment_hashes(block.data, found.starts, found.ends, lower=True), found


def shingle_hashes(block: Block, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of all ``size``-word shingles, in row order.

    A row with fewer words has its whole word sequence as its one shingle.
    """
    value, found = word_hashes(block)
    rows = len(block.offsets) - 1
    count = np.bincount(found.row, minlength=rows)
    n = max(0, len(value) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        total += value[k:k + n] * _POSITION[k]
    inside = found.row[:n] == found.row[size - 1:size - 1 + n]
    out, row = mix(total[inside]), found.row[:n][inside]
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        first = np.concatenate([[0], np.cumsum(count)])
        extra = [mix(np.array([(value[first[r]:first[r + 1]] * _POSITION[:count[r]]).sum(dtype=np.uint64)
                               ^ np.uint64(count[r] * 0x51ED27)], dtype=np.uint64))[0] for r in short]
        out = np.concatenate([out, np.array(extra, dtype=np.uint64)])
        row = np.concatenate([row, short])
        order = np.argsort(row, kind="stable")
        out, row = out[order], row[order]
    return out, row


def sorted_sets(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes per row, sorted; their rows; rows that have any."""
    value, row = shingle_hashes(block)
    edges = np.flatnonzero(np.diff(row)) + 1
    for part in np.split(value, edges):
        part.sort()
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    value, row = value[fresh], row[fresh]
    return value, row, np.unique(row)
