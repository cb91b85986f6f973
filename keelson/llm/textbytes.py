"""Vectorised work on the UTF-8 bytes of Arrow text columns.

The operators of this subpackage see a text column as one flat byte array
plus row offsets, in chunks of a few megabytes, and find and hash words with
numpy. A row is never split: a chunk holds at least one whole text, so the
memory of a task follows its longest text, not its partition.

Words are named by a 64-bit multilinear hash (a random odd multiplier for each
byte position): two different words collide with a chance under 2^-56.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 2048

# Word alphabets: every byte but space and \t..\r; or digits, a-z and the bytes of non-ASCII characters.
SPACELESS = np.ones(256, bool)
SPACELESS[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64's)."""
    x = np.array(x, dtype=U64, copy=True, ndmin=1)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def randoms(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd 64-bit numbers."""
    step = np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15)
    return mix(step + U64(seed)) | U64(1)


_MULTIPLIERS = randoms(256, 11)


def _multipliers(n: int) -> np.ndarray:
    global _MULTIPLIERS
    if n > len(_MULTIPLIERS):
        _MULTIPLIERS = randoms(max(n, 2 * len(_MULTIPLIERS)), 11)
    return _MULTIPLIERS


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the row offsets (from 0) of a string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offs = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offs - offs[0]


def give_back() -> None:
    """Return freed memory to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def task(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """``run`` for mapInArrow; the worker, which Spark keeps, gives freed memory back when it begins and ends.

    At the beginning that is what Spark has just let go: the broadcasts of an earlier stage.
    """

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``run`` for applyInArrow; freed memory goes back after each group."""

    def wrapped(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return wrapped


def chunks(column: pa.Array, limit: int = CHUNK_BYTES, rows: int = CHUNK_ROWS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows.

    A chunk has about ``limit`` bytes or one text, and ``rows`` rows at most.
    """
    raw, offs = text_buffers(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, lo + rows, n)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def word_spans(buf: np.ndarray, offs: np.ndarray, alphabet: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each row the number of the first word at or after its start."""
    inside = alphabet[buf]
    edge = np.empty(len(buf) + 1, bool)
    edge[:-1] = inside
    edge[-1] = False
    before = np.empty_like(edge)
    before[0] = False
    before[1:] = inside
    cut = offs[(offs > 0) & (offs < len(buf))]
    starts = edge & ~before
    ends = before & ~edge
    starts[cut] |= inside[cut]
    ends[cut] |= inside[cut - 1]
    s = np.flatnonzero(starts)
    return s, np.flatnonzero(ends), np.searchsorted(s, offs).astype(np.int64)


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each word."""
    if not len(starts):
        return np.zeros(0, U64)
    lens = ends - starts
    first = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=first[1:])
    within = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    at = within + np.repeat(starts, lens)
    terms = (buf[at].astype(U64) + U64(1)) * _multipliers(int(lens.max()))[within]
    return mix(np.add.reduceat(terms, first))


def combine(parts: list[np.ndarray], seed: int) -> np.ndarray:
    """One hash from several hashes, position by position (order counts)."""
    r = randoms(len(parts), seed)
    total = parts[0] * r[0]
    for i in range(1, len(parts)):
        total = total + parts[i] * r[i]
    return mix(total)


def row_of(offsets: np.ndarray) -> np.ndarray:
    """The row number of every item, from item offsets by row."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def int64_values(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_numpy(zero_copy_only=False))
