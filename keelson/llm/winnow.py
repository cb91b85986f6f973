"""Winnowing: content-chosen anchors, and the anchors that occur more than once.

Of every window of ``width`` successive hashes the leftmost smallest is its
anchor. Equal windows have equal anchors at equal places, so a repeated window
is only to be looked for where its anchor repeats. Which anchors repeat is
found by one shuffle of packed fingerprints and kept as a bitmap of fixed size
(16 MB, whatever the data): a clash costs a needless candidate, never a miss.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from keelson.llm import textbytes as tb

BITMAP_BITS = 1 << 27
FLUSH = 2_000_000
_HIGH = np.uint64(0xFFFFFFFF00000000)


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each window start (``len(hashes) - width + 1`` of them) the place of its anchor."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    least = (hashes & _HIGH) | np.arange(len(hashes), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[:n], least[width - span : width - span + n])
    return (least[:n] & ~_HIGH).astype(np.int64)


def runs(place: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchors with the first and last window start they serve; ``starts`` ascending, ``place`` their anchors."""
    if not len(place):
        return place, starts, starts
    new = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1))))
    last = np.concatenate((new[1:] - 1, [len(place) - 1]))
    return place[new], starts[new], starts[last]


def slot(fingerprints: np.ndarray) -> np.ndarray:
    return (tb.mix(fingerprints) >> np.uint64(64 - (BITMAP_BITS.bit_length() - 1))).astype(np.int64)


def repeated(texts: DataFrame, find: Callable[[np.ndarray, np.ndarray], np.ndarray], parts: int, limit: int = tb.CHUNK_BYTES) -> np.ndarray:
    """The bitmap (packed, little-endian) of the slots of anchors that occur more than once.

    ``texts`` has one string column; ``find(bytes, offsets)`` gives the anchors'
    fingerprints of a chunk of rows.
    """
    step = -(-BITMAP_BITS // parts // 8) * 8  # slots of a part

    def emit(found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        f, n = np.unique(np.concatenate(found), return_counts=True)
        f = np.repeat(f, np.minimum(n, 2))
        part = slot(f) // step
        order = np.argsort(part, kind="stable")
        f = f[order]
        cut = np.searchsorted(part[order], np.arange(parts + 1))
        some = np.flatnonzero(np.diff(cut))
        for lo in range(0, len(some), 64):
            group = some[lo : lo + 64]
            # Byte planes: the high bytes of sorted numbers compress well.
            blobs = [np.ascontiguousarray(f[cut[p] : cut[p + 1]].view(np.uint8).reshape(-1, 8).T[1:]).tobytes() for p in group]
            yield pa.RecordBatch.from_arrays([pa.array(group, pa.int32()), pa.array(blobs, pa.binary())], ["part", "found"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for _, _, buf, offs in tb.chunks(batch.column(0), limit):
                found.append(find(buf, offs) & np.uint64(0xFFFFFFFFFFFFFF00))
                size += len(found[-1])
                if size > FLUSH:
                    yield from emit(found)
                    found, size = [], 0
        if size:
            yield from emit(found)

    def mark(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        flat = []
        for blob in table["found"].to_pylist():
            planes = np.frombuffer(blob, np.uint8).reshape(7, -1)
            whole = np.zeros((planes.shape[1], 8), np.uint8)
            whole[:, 1:] = planes.T
            flat.append(whole.view(np.uint64).reshape(-1))
        f = np.sort(np.concatenate(flat))
        twice = np.unique(f[1:][f[1:] == f[:-1]])
        bits = np.zeros(step, np.uint8)
        bits[slot(twice) - part * step] = 1
        return pa.table({"part": pa.array([part], pa.int32()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()])})

    slices = texts.mapInArrow(tb.task(run), "part int, found binary").groupBy("part").applyInArrow(tb.group(mark), "part int, bits binary")
    bitmap = np.zeros(parts * step // 8, np.uint8)
    for row in slices.toLocalIterator():
        bitmap[row["part"] * step // 8 : (row["part"] + 1) * step // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return bitmap


def in_bitmap(bitmap: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
    s = slot(fingerprints & np.uint64(0xFFFFFFFFFFFFFF00))
    return (bitmap[s >> 3] >> (s & 7).astype(np.uint8)) & 1 > 0
