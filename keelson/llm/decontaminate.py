"""Benchmark decontamination with an FM-index for each training shard.

The benchmark is the stated query set: its phrases (windows of ``window``
words; an item of fewer words is one phrase) are prepared once and sent to all
tasks in blocks of at most ``BLOCK_BYTES`` of text. A task cuts its documents
into shards of a megabyte. Of a shard it indexes every run of words that
the benchmark knows, if the run is as long as the shortest phrase (an
occurrence cannot hold any other word), searches all phrases backward through
the wavelet ranks, locates the occurrences by sampled suffix positions and
merges them into removal spans. Nothing is shuffled.

Words: A-Z lower-cased, then maximal runs of digits, letters a-z and non-ASCII
characters. Defined results: a null text has no words; a benchmark row without
words is never found; a null item id still marks words but is not listed;
repeated item ids count once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textbytes as tb
from keelson.llm.fmindex import FMIndex

BLOCK_BYTES = 8 << 20
#: Text of a shard; a worker takes about 50 bytes for each byte of it.
SHARD_BYTES = 1 << 20
WINDOW = 10


class Phrases:
    """The distinct phrases of a block of benchmark items, as word numbers from 1."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int):
        names = sorted({i for i, _ in items if i is not None})
        number = {name: k for k, name in enumerate(names)}
        self.items = names
        column = pa.array([t for _, t in items], pa.string())
        raw, offs = tb.text_buffers(column)
        buf = tb.LOWER[raw]
        starts, ends, first = tb.word_spans(buf, offs, tb.ALNUM)
        hashes = tb.word_hashes(buf, starts, ends)
        self.vocabulary = np.unique(hashes)
        ids = np.searchsorted(self.vocabulary, hashes) + 1
        by_phrase: dict[tuple[int, ...], set[int]] = {}
        for k, (name, _) in enumerate(items):
            words = ids[first[k] : first[k + 1]].tolist()
            for at in range(max(1, len(words) - window + 1)) if words else ():
                owners = by_phrase.setdefault(tuple(words[at : at + window]), set())
                if name is not None:
                    owners.add(number[name])
        self.shortest = min(map(len, by_phrase), default=0)
        #: By phrase length: the phrases as rows, and their owners as (starts, flat numbers).
        self.tables = []
        for length in sorted({len(p) for p in by_phrase}):
            rows = [(p, sorted(o)) for p, o in by_phrase.items() if len(p) == length]
            counts = [len(o) for _, o in rows]
            flat = np.array([x for _, o in rows for x in o], np.int64)
            self.tables.append((np.array([p for p, _ in rows], np.int64), np.cumsum([0, *counts]), flat))

    def find(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For the words of a shard: which are hit, and the distinct (row, item number) pairs."""
        hit = np.zeros(len(hashes) + 1, np.int64)
        none = np.zeros((0, 2), np.int64)
        if not self.tables or not len(hashes):
            return hit[:-1].astype(bool), none
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        known = self.vocabulary[at] == hashes
        row = tb.row_of(first)
        # Maximal runs of known words of one document.
        joins = known[1:] & known[:-1] & (row[1:] == row[:-1])
        begins = np.flatnonzero(known & ~np.concatenate(([False], joins)))
        ends = np.flatnonzero(known & ~np.concatenate((joins, [False]))) + 1
        long = ends - begins >= self.shortest
        begins, lens = begins[long], (ends - begins)[long]
        if not len(begins):
            return hit[:-1].astype(bool), none
        put = np.cumsum(lens + 1) - (lens + 1)  # each run is followed by a 0
        seq = np.zeros(int(put[-1] + lens[-1]) + 1, np.int64)
        word = np.full(len(seq), -1, np.int64)
        run = np.repeat(np.arange(len(lens)), lens)
        within = np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens)
        seq[put[run] + within] = at[begins[run] + within] + 1
        word[put[run] + within] = begins[run] + within
        index = FMIndex(seq)
        pairs = []
        for phrases, owner_first, owners in self.tables:
            lo, hi = index.search(phrases)
            count = hi - lo
            which = np.repeat(np.arange(len(phrases)), count)
            if not len(which):
                continue
            rows = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)
            place = word[index.locate(rows)]
            hit += np.bincount(place, minlength=len(hit)) - np.bincount(place + phrases.shape[1], minlength=len(hit))
            seen = np.unique(np.stack((row[place], which), 1), axis=0)
            n = np.diff(owner_first)[seen[:, 1]]
            flat = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(owner_first[seen[:, 1]], n)
            pairs.append(np.stack((np.repeat(seen[:, 0], n), owners[flat]), 1))
        found = np.unique(np.concatenate(pairs), axis=0) if pairs else none
        return np.cumsum(hit)[:-1] > 0, found


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> list[Phrases]:
    """The benchmark in blocks of bounded text; rows come one partition at a time."""
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("string")).distinct()
    blocks, items, size = [], [], 0
    for item, text in rows.toLocalIterator():
        items.append((item, text))
        size += len(text or "") * 4
        if size > BLOCK_BYTES:
            blocks.append(Phrases(items, window))
            items, size = [], 0
    return [*blocks, Phrases(items, window)] if items or not blocks else blocks


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, spans, items``.

    ``spans`` are the maximal runs of hit words, as word numbers (start, end);
    ``items`` the ids of the benchmark items with an occurring phrase, sorted
    as strings.
    """
    spark = docs.sparkSession
    shared = [spark.sparkContext.broadcast(b) for b in _blocks(benchmark, item_col, item_text_col, window)]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, offs in tb.chunks(batch.column(1), SHARD_BYTES):
                buf = tb.LOWER[raw]
                starts, ends, first = tb.word_spans(buf, offs, tb.ALNUM)
                hashes = tb.word_hashes(buf, starts, ends)
                hit = np.zeros(len(hashes), bool)
                names: list[set[str]] = [set() for _ in range(hi - lo)]
                for block in shared:
                    h, pairs = block.value.find(hashes, first)
                    hit |= h
                    for r, item in pairs.tolist():
                        names[r].add(block.value.items[item])
                spans: list[list[dict]] = [[] for _ in names]
                row = tb.row_of(first)
                joins = hit[1:] & hit[:-1] & (row[1:] == row[:-1])
                begin = np.flatnonzero(hit & ~np.concatenate(([False], joins))) if len(hit) else []
                end = np.flatnonzero(hit & ~np.concatenate((joins, [False]))) + 1 if len(hit) else []
                for b, e in zip(begin, end, strict=True):
                    r = row[b]
                    spans[r].append({"start": int(b - first[r]), "end": int(e - first[r])})
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(spans, span),
                        pa.array([sorted(n) for n in names], pa.list_(pa.string())),
                    ],
                    ["doc_id", "n_words", "spans", "items"],
                )

    schema = f"doc_id {id_type}, n_words bigint, spans array<struct<start:int,end:int>>, items array<string>"
    return rows.mapInArrow(tb.task(search), schema)
