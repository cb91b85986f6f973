"""Best-fit packing of tokenised documents into sequences, planned on the histogram of lengths.

1. Every text is encoded where it is read and cut into pieces of at most
   ``capacity`` tokens.
2. Pieces are counted by length. That histogram has at most ``capacity`` rows
   whatever the table, so the driver plans on it: best fit over counts, the
   longest lengths first. All sequences with the same room left are a few
   intervals of numbers, and a step of the plan fills a whole interval.
3. The pieces of a length are ranked (range partitions, then prefix sums of
   their counts, so a length that holds most rows has no task of its own) and
   take the slots the plan gives to their ranks.

Defined results: a null or empty text is the end token alone; a repeated row
is packed as often as it occurs; ids may be null; ties of length are ranked by
id, piece and digest; an empty table gives no rows. Columns of the input other
than the id and the text are not read, so their names cannot clash. A very
long text is encoded whole, in one task, and only then cut.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.scratch import stored
from keelson.llm.textbytes import chunks, task
from keelson.llm.word_tokens import word_encoder

CHUNK_BYTES = 4 << 20


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32[, token_ids]`` for each piece of each document.

    A document is its text's ids by ``tokenizer`` (a file of the tokenizers
    library, no special tokens added, their strings read as plain text) and
    ``end_id``. ``token_ids`` are little-endian unsigned 32-bit integers.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    fields = [rows.schema["doc_id"]]
    fields += [T.StructField(n, T.LongType()) for n in ("piece", "start", "length", "ids_crc32")]
    if with_ids:
        fields.append(T.StructField("token_ids", T.BinaryType()))

    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())  # a vocabulary: a few MB, whatever the table

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(spec.value)
        for batch in batches:
            for lo, hi, buf, offs in chunks(batch.column("text"), CHUNK_BYTES):
                ids, place = encoder.encode(buf, offs)
                yield _cut(batch.column("doc_id").slice(lo, hi - lo), ids, place, capacity, end_id, with_ids)

    return rows.mapInArrow(task(cut), T.StructType(fields))


def _cut(doc_ids: pa.Array, ids: np.ndarray, place: np.ndarray, capacity: int, end_id: int, with_ids: bool) -> pa.RecordBatch:
    size = np.diff(place) + 1
    count = -(-size // capacity)
    row = np.repeat(np.arange(len(size)), count)
    number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start = number * capacity
    length = np.minimum(capacity, size[row] - start)
    whole = np.insert(ids.astype("<u4"), place[1:], end_id).tobytes()
    at = 4 * (place[row] + row + start)
    parts = [whole[a:b] for a, b in zip(at.tolist(), (at + 4 * length).tolist())]
    columns = [doc_ids.take(pa.array(row)), number, start, length, [zlib.crc32(p) for p in parts]]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    if with_ids:
        columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "token_ids"]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns], names
    )


class Plan:
    """Slots for the pieces of each length, by their rank among the pieces of that length.

    A step gives ``per_sequence`` consecutive ranks to each of consecutive
    sequences, beginning at ``offset`` in each. The steps of a length cover its
    ranks from 0 on.
    """

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity = capacity
        self.sequences = 0
        self._steps: dict[int, list[tuple[int, int, int, int]]] = {}
        room: dict[int, list[tuple[int, int]]] = {}  # room left: intervals of sequences
        for length in sorted(counts, reverse=True):
            if not 0 < length <= capacity:
                raise ValueError(f"length {length} is outside 1 to {capacity}")
            self._place(length, counts[length], room)
        self._arrays = {n: np.array(s, np.int64).T for n, s in self._steps.items()}

    def _place(self, length: int, count: int, room: dict[int, list[tuple[int, int]]]) -> None:
        steps, rank = self._steps.setdefault(length, []), 0
        # A sequence with room r takes floor(r / length) of them one after the other: after each it has the least room.
        fitting = [r for r in room if r >= length]
        heapq.heapify(fitting)
        while rank < count and fitting:
            left = heapq.heappop(fitting)
            each = left // length
            spans = room.pop(left)
            while spans and rank < count:
                first, end = spans.pop()
                used = min(end - first, -(-(count - rank) // each))
                rank = self._fill(steps, room, length, left, first, used, rank, count)
                if first + used < end:
                    spans.append((first + used, end))
            if spans:
                room.setdefault(left, []).extend(spans)
        if rank < count:
            used = -(-(count - rank) // (self.capacity // length))
            first, self.sequences = self.sequences, self.sequences + used
            self._fill(steps, room, length, self.capacity, first, used, rank, count)

    def _fill(self, steps, room, length, left, first, used, rank, count) -> int:
        """Give the next ranks to ``used`` sequences from ``first``, which have ``left`` room; the last may get fewer."""
        each = left // length
        steps.append((rank, first, each, self.capacity - left))
        after = min(count, rank + used * each)
        last = after - rank - (used - 1) * each
        full = used if last == each else used - 1
        if full and left - each * length:
            room.setdefault(left - each * length, []).append((first, first + full))
        if full < used and left - last * length:
            room.setdefault(left - last * length, []).append((first + full, first + used))
        return after

    def slots(self, length: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``sequence, offset`` of the pieces with these ranks."""
        begin, first, each, base = self._arrays[length]
        step = np.searchsorted(begin, ranks, "right") - 1
        within = ranks - begin[step]
        return first[step] + within // each[step], base[step] + within % each[step] * length


def _runs(lengths: np.ndarray) -> np.ndarray:
    """Positions where a new length begins."""
    return np.flatnonzero(np.append(True, lengths[1:] != lengths[:-1])) if len(lengths) else np.zeros(0, np.int64)


def _numbered(cut: DataFrame) -> DataFrame:
    """``cut`` in range partitions by length, each row with its part and its number among the part's rows of its length."""
    names = ["length", "doc_id", "piece", "ids_crc32"]
    width = max(2, int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = cut.repartitionByRange(width, *names, "arrival").sortWithinPartitions(*names)
    parts = ranged.withColumn("part", F.spark_partition_id())
    schema = T.StructType([f for f in parts.schema if f.name != "arrival"] + [T.StructField("number", T.LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            if not len(lengths):
                continue
            begins = _runs(lengths)
            run = np.repeat(begins, np.diff(np.append(begins, len(lengths))))
            number = np.arange(len(lengths)) - run
            if lengths[0] == last:
                number[run == 0] += seen
            last, seen = lengths[-1], int(number[-1]) + 1
            columns = [batch.column(f.name) for f in schema[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(number)], schema.names)

    return parts.mapInArrow(count, schema)


def pack(cut: DataFrame, capacity: int = 2048) -> DataFrame:
    """The rows of ``pieces`` with ``sequence_id`` and ``offset``.

    ``sequence_id`` runs from 0 without gaps; within a sequence the pieces
    follow each other from offset 0.
    """
    spark = cut.sparkSession
    columns = cut.columns
    ready = stored(cut.withColumn("arrival", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["n"] for r in ready.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows
    plan = spark.sparkContext.broadcast(Plan(counts, capacity))  # its size depends on capacity alone
    numbered = stored(_numbered(ready), "numbered")
    # One row for each part and length it holds: parts + capacity rows.
    held = numbered.groupBy("length", "part").agg(F.count("*").alias("n"))
    earlier = F.coalesce(F.expr("sum(n) OVER (PARTITION BY length ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0))
    before = held.select("length", "part", earlier.alias("before"))
    ranked = numbered.join(F.broadcast(before), ["length", "part"])
    ranked = ranked.select(*columns, (F.col("number") + F.col("before")).alias("rank"))
    schema = T.StructType(
        [*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
            begins = _runs(lengths)
            for a, b in zip(begins.tolist(), [*begins[1:].tolist(), len(lengths)]):
                sequence[a:b], offset[a:b] = plan.value.slots(int(lengths[a]), ranks[a:b])
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], schema.names)

    return ranked.mapInArrow(place, schema)
