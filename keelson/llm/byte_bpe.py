"""Byte-level BPE encoding and decoding with a two-tier lookup.

A vocabulary is a rank file (base64 token and rank on each line) and a split
pattern. Each match of the pattern (a pre-token) is encoded separately:

* tier one, a minimal perfect hash over the vocabulary (hash and displace):
  one probe finds the only token the pre-token can be, one comparison tells
  whether it is;
* tier two, for the others, merges the bytes pair by pair, lowest rank first
  and leftmost among equals: a heap of pair ranks over a doubly linked list of
  byte pieces.

Results of both tiers are remembered for the pre-tokens seen lately, in a
cache of bounded size. Nothing is shuffled; a task holds one Arrow batch.

Defined results: a null text is empty (no ids); special tokens are never
recognised; decoding gives bytes, which need not be valid UTF-8 when the ids
are not an encoder's.
"""

from __future__ import annotations

import base64
import heapq
import weakref
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textbytes as tb

CACHE_ENTRIES = 100_000
BUCKET = 4
_MASK = (1 << 64) - 1
_CHUNK = 1 << 20


class PerfectHash:
    """A minimal perfect hash: n keys to the places 0..n-1, one displacement for about four keys."""

    def __init__(self, keys: list[bytes]):
        self.n = len(keys)
        self.m = max(1, self.n // BUCKET)
        self.shift = [0] * self.m
        hashes = [xxhash.xxh3_64_intdigest(k) for k in keys]
        buckets: list[list[int]] = [[] for _ in range(self.m)]
        for i, h in enumerate(hashes):
            buckets[h % self.m].append(i)
        self.key_at = [-1] * self.n
        for b in sorted(range(self.m), key=lambda b: -len(buckets[b])):
            members = buckets[b]
            if len(members) < 2:
                break
            d = 1
            while True:
                places = [self._place(hashes[i], d) for i in members]
                if len(set(places)) == len(places) and all(self.key_at[p] < 0 for p in places):
                    break
                d += 1
            self.shift[b] = d
            for i, p in zip(members, places, strict=True):
                self.key_at[p] = i
        free = (p for p in range(self.n) if self.key_at[p] < 0)
        for b in range(self.m):
            if len(buckets[b]) == 1:
                p = next(free)
                self.shift[b] = -p - 1  # a lone key's place, written down
                self.key_at[p] = buckets[b][0]

    def _place(self, h: int, d: int) -> int:
        x = ((h ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9) & _MASK
        return (x >> 29) % self.n

    def place(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.m]
        return self._place(h, d) if d >= 0 else -d - 1


class Vocabulary:
    """Ranks, the perfect hash over their tokens, and the split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = pattern
        keys = list(ranks)
        self.hash = PerfectHash(keys)
        self.keys = [keys[i] for i in self.hash.key_at]
        self.ids = [ranks[k] for k in self.keys]
        self.tokens = {r: k for k, r in ranks.items()}

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "_pieces"}

    def pieces(self) -> _Pieces:
        """The cache of this process: it outlives a task, as the broadcast vocabulary does."""
        if "_pieces" not in self.__dict__:
            self._pieces = _Pieces(self)
        return self._pieces

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as f:
            return cls({base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}, pattern)

    def whole(self, piece: bytes) -> int | None:
        """Tier one: the id of a pre-token that is in the vocabulary."""
        if not self.keys:
            return None
        p = self.hash.place(piece)
        return self.ids[p] if self.keys[p] == piece else None

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Tier two: merge pairs of linked pieces, lowest rank first, leftmost among equals."""
        rank = self.ranks.get
        n = len(piece)
        after = [*range(1, n + 1), n]  # where the piece that begins at i ends; 0 once it is merged away
        before = list(range(-1, n))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, e = heapq.heappop(heap)
            j = after[i]
            if not j or j >= n or after[j] != e:
                continue  # one of the two has changed since
            after[j] = 0
            after[i] = e
            if e < n:
                before[e] = i
                f = after[e]
                if (x := rank(piece[i:f])) is not None:
                    heapq.heappush(heap, (x, i, f))
            k = before[i]
            if k >= 0 and (x := rank(piece[k:e])) is not None:
                heapq.heappush(heap, (x, k, e))
        out, i = [], 0
        while i < n:
            e = after[i]
            out.append(self.ranks[piece[i:e]])
            i = e
        return tuple(out)


class _Pieces(dict):
    """Pre-token to ids, for the pre-tokens seen lately: two generations of bounded size."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = weakref.proxy(vocabulary)  # no cycle: both go at once with the broadcast
        self.older: dict[str, tuple[int, ...]] = {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self.older.get(word)
        if ids is None:
            piece = word.encode()
            one = self.vocabulary.whole(piece)
            ids = (one,) if one is not None else self.vocabulary.merged(piece)
        if len(word) <= 64:
            if len(self) >= CACHE_ENTRIES:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


class Codec:
    """Encoder and decoder of one task."""

    def __init__(self, vocabulary: Vocabulary):
        self.split = regex.compile(vocabulary.pattern).findall
        self.vocabulary = vocabulary
        self.pieces = vocabulary.pieces()
        self.tokens = vocabulary.tokens

    def encode(self, text: str) -> array:
        return array("I", chain.from_iterable(map(self.pieces.__getitem__, self.split(text))))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_tokens, token_ids`` (little-endian unsigned 32-bit integers)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            for lo, hi, _, _ in tb.chunks(batch.column(1), _CHUNK):
                ids = [np.array(codec.encode(t or ""), "<u4") for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(map(len, ids), pa.int64()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "token_ids"],
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tb.task(run), f"doc_id {id_type}, n_tokens bigint, token_ids binary")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Adds ``decoded`` (bytes) to the rows of ``encode``; null ids decode to no bytes."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    rows = encoded.select("doc_id", "n_tokens", "token_ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            for lo, hi, _, _ in tb.chunks(batch.column(2), 2 * _CHUNK):
                part = batch.slice(lo, hi - lo)
                raw = part.column(2).to_pylist()
                decoded = [codec.decode(np.frombuffer(x or b"", "<u4").tolist()) for x in raw]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(decoded, pa.binary())], [*part.schema.names, "decoded"])

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tb.task(run), f"doc_id {id_type}, n_tokens bigint, token_ids binary, decoded binary")


def round_trip(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``doc_id, n_tokens, token_ids, decoded``."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shared.value)
        for batch in batches:
            for lo, hi, _, _ in tb.chunks(batch.column(1), _CHUNK):
                ids = [codec.encode(t or "") for t in batch.column(1).slice(lo, hi - lo).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(map(len, ids), pa.int64()),
                        pa.array([np.array(x, "<u4").tobytes() for x in ids], pa.binary()),
                        pa.array([codec.decode(x) for x in ids], pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "token_ids", "decoded"],
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tb.task(run), f"doc_id {id_type}, n_tokens bigint, token_ids binary, decoded binary")
