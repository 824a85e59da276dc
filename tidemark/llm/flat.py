"""Words and shingles of Arrow batches as flat numpy arrays.

The texts of a batch lie end to end in one byte array, so tokens and their
hashes come from a few vectorised passes without a loop over words. Batches are
cut into runs of rows of bounded size first; a single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; one longer text forms a run of its own.
RUN_BYTES = 1 << 21

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

_BYTE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.random.default_rng(20240102).integers(1, 1 << 63, 16, np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """The first n powers of an odd number modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        values = np.full(max(n, RUN_BYTES + 1), base, np.uint64)
        values[0] = 1
        have = _powers[base] = np.multiply.accumulate(values)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def runs(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut into runs of rows with about RUN_BYTES of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + RUN_BYTES, "right")))
            yield batch.slice(first, last - first)
            first = last


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column end to end, and where each row begins (null: empty)."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each row (one entry more than rows)."""
    return runs_of(~WHITE, data, offsets)


def runs_of(kind: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Like word_bounds, for runs of the bytes that ``kind`` (a table of 256) holds."""
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = kind[data]
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    starts = np.flatnonzero(inside[:-1] & (begins[:-1] | ~np.concatenate([[False], inside[:-2]])))
    ends = np.flatnonzero(inside[:-1] & (begins[1:] | ~inside[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span; ``lower`` takes A-Z as a-z."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * powers(_BASE, len(data)), out=total[1:])
    sums = (total[ends] - total[starts]) * powers(_INVERSE, len(data) + 1)[starts]
    return mix(sums + (ends - starts).astype(np.uint64))


def words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the first word of each row."""
    data, offsets = flat_bytes(column)
    starts, ends, first = word_bounds(data, offsets)
    return span_hashes(data, starts, ends, lower), first


def shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ``size``-word windows of each row in order, and the first window of each row.

    A row with fewer words has one window, all its words; a row without words none.
    """
    counts = np.diff(first)
    windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    begin = np.concatenate([[0], np.cumsum(windows)])
    row = np.repeat(np.arange(len(counts)), windows)
    at = first[:-1][row] + np.arange(begin[-1]) - begin[row]
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    whole = np.minimum(counts, size)[row]
    out = whole.astype(np.uint64)
    for k in range(size):
        out += np.where(whole > k, padded[at + k], np.uint64(0)) * _STEP[k]
    return mix(out), begin


def shingle_sets(column: pa.Array, size: int, lower: bool = True) -> list[np.ndarray]:
    """The sorted distinct shingles of each row."""
    values, begin = shingles(*words(column, lower), size)
    return [np.unique(values[a:b]) for a, b in zip(begin[:-1], begin[1:], strict=True)]
