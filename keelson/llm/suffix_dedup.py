"""Suffix-array deduplication of repeated word windows.

A window of ``window`` words is removed from every place but the first it
starts at (smallest id, then earliest). The suffixes that can tell are sorted:

1. winnowing (``winnow``) picks suffix starts such that every window holds one
   within its first ``window - GRAM + 1`` words, and a fixed-size bitmap says
   which of their leading ``GRAM`` words occur more than once;
2. those suffixes, with the words their windows need, are range-partitioned by
   their leading words at sampled splitters (Spark's range partitioner). Equal
   leading words are ordered by id and place, so a passage that a third of the
   documents share is spread over as many buckets as it needs;
3. a bucket sorts its suffixes by multikey quicksort on words and marks all
   windows but the first of each class of equals;
4. classes that touch a bucket's boundary may go on in its neighbours: their
   first windows are compared across boundaries by one more small grouping;
5. the marks are joined to their documents, and covered words are cut out.

Words are maximal runs without ASCII white space, unchanged, compared by 48
bits of a hash each (windows that differ in one word only are confused with a
chance of 2^-48). Defined results: a null text has no words; a text shorter
than a window loses nothing; null ids come last; rows that repeat id and text
are one document; rows that share an id (or null) but not the text are
documents of their own, in the order of a digest of their texts, after all
smaller ids (``docids``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import docids, keyset, winnow
from keelson.llm import textbytes as tb
from keelson.llm.scratch import stored

WINDOW = 20
GRAM = 8
SMALL = 512
_WORD = 6  # bytes of a word's hash in a suffix


def _grams(h: np.ndarray) -> np.ndarray:
    n = max(0, len(h) - GRAM + 1)
    return tb.combine([h[i : i + n] for i in range(GRAM)], 61) if n else np.zeros(0, np.uint64)


def suffix_starts(h: np.ndarray, first: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of all windows of a chunk, the first and last window start of each, and all gram hashes."""
    grams = _grams(h)
    width = window - GRAM + 1
    place = winnow.anchors(grams, width)
    row = tb.row_of(first)
    starts = np.flatnonzero(row[: len(place)] == row[window - 1 : window - 1 + len(place)]) if len(place) else np.zeros(0, np.int64)
    # A window start of another row than the one before begins a new run even where the anchor is the same word.
    return *winnow.runs(place[starts], starts), grams


def multikey_order(columns: np.ndarray) -> np.ndarray:
    """Stable order of the rows of ``columns`` (words as numbers) by three-way quicksort, word by word."""
    n, depth = columns.shape
    order = np.arange(n)
    todo = [(0, n, 0)]
    while todo:
        lo, hi, d = todo.pop()
        if hi - lo < 2 or d == depth:
            continue
        part = order[lo:hi]
        if hi - lo <= SMALL:
            order[lo:hi] = part[np.lexsort(columns[part][:, d:].T[::-1])]
            continue
        key = columns[part, d]
        pivot = np.partition(key[:: max(1, len(key) // 31)], -1 if len(key) < 31 else 15)[15 if len(key) >= 31 else -1]
        less, more = key < pivot, key > pivot
        equal = ~(less | more)
        a, b = int(less.sum()), int(equal.sum())
        order[lo : lo + a], order[lo + a : lo + a + b], order[lo + a + b : hi] = part[less], part[equal], part[more]
        todo += [(lo, lo + a, d), (lo + a, lo + a + b, d + 1), (lo + a + b, hi, d)]
    return order


def _suffixes(docs: DataFrame, bitmap: np.ndarray, window: int) -> DataFrame:
    """``doc_id, place, back, ahead, words``: candidate suffixes with the words of their windows.

    ``place`` is the suffix's first word; its windows start ``ahead .. back`` words before it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, _, buf, offs in tb.chunks(batch.column(1)):
                starts, ends, first = tb.word_spans(buf, offs, tb.SPACELESS)
                h = tb.word_hashes(buf, starts, ends)
                place, a, b, grams = suffix_starts(h, first, window)
                some = winnow.in_bitmap(shared.value, grams[place])
                place, a, b = place[some], a[some], b[some]
                if not len(place):
                    continue
                # Big-endian, so that bytes and words sort alike.
                packed = np.ascontiguousarray(h.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :_WORD])
                count = b - a + window
                off = np.concatenate(([0], np.cumsum(count)))
                pick = np.arange(off[-1]) - np.repeat(off[:-1], count) + np.repeat(a, count)
                row = np.searchsorted(first, place, "right") - 1
                data = packed[pick].tobytes()
                words = pa.BinaryArray.from_buffers(
                    pa.binary(), len(place), [None, pa.py_buffer((off * _WORD).astype(np.int32).tobytes()), pa.py_buffer(data)]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row + lo)),
                        pa.array((place - first[row]).astype(np.int32)),
                        pa.array((place - a).astype(np.int32)),
                        pa.array((place - b).astype(np.int32)),
                        words,
                    ],
                    ["doc_id", "place", "back", "ahead", "words"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(tb.task(run), f"doc_id {id_type}, place int, back int, ahead int, words binary")


def _marked(suffixes: DataFrame, window: int) -> DataFrame:
    """``doc_id, place, mask, k1, k2``: bit i marks the window that starts i words before ``place`` as repeated.

    Rows with ``k1, k2`` are windows (at ``place``) that are the first of their class in a
    bucket whose boundary the class touches.
    """
    back_most = window - GRAM

    def matrix(table: pa.Table) -> np.ndarray:
        """The words around each suffix start: column ``back_most`` is its first word; 0 where not sent."""
        raw, offs = tb.text_buffers(table["words"])
        count = np.diff(offs) // _WORD
        wide = np.zeros((int(offs[-1]) // _WORD, 8), np.uint8)
        wide[:, :_WORD] = raw.reshape(-1, _WORD)
        flat = wide.view(">u8").reshape(-1).astype(np.uint64)
        out = np.zeros((len(count), back_most + window), np.uint64)
        row = np.repeat(np.arange(len(count)), count)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
        col += np.repeat(back_most - table["back"].to_numpy(), count)
        out[row, col] = flat
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not len(table):
            return
        # Id, then place: the sorts below are stable.
        ids = table["doc_id"].combine_chunks()
        rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="dense").to_numpy().astype(np.int64)
        order = np.lexsort((table["place"].to_numpy(), rank))
        table, rank = table.take(pa.array(order)), rank[order]
        place, back, ahead = (table[c].to_numpy().astype(np.int64) for c in ("place", "back", "ahead"))
        words = matrix(table)
        lead = words[:, back_most : back_most + GRAM]
        by_lead = np.lexsort(lead.T[::-1])
        outer = (lead == lead[by_lead[0]]).all(1) | (lead == lead[by_lead[-1]]).all(1)
        mask = np.zeros(len(table), np.int32)
        open_at, open_start, open_keys = [], [], []
        for i in range(back_most + 1):
            rows = np.flatnonzero((ahead <= i) & (i <= back))
            if not len(rows):
                continue
            own = words[rows, back_most - i : back_most - i + window]
            order = multikey_order(own)
            own, at = own[order], rows[order]
            new = np.concatenate(([True], (own[1:] != own[:-1]).any(1)))
            first = at[np.flatnonzero(new)][np.cumsum(new) - 1]
            again = (rank[at] != rank[first]) | (place[at] != place[first])
            mask[at[again]] |= 1 << i
            touching = new & outer[at]
            open_at.append(at[touching])
            open_start.append(place[at[touching]] - i)
            open_keys.append(own[touching])
        got = np.flatnonzero(mask)
        nothing = pa.nulls(len(got), pa.int64())
        ids = table["doc_id"].combine_chunks()
        names = ["doc_id", "place", "mask", "k1", "k2"]
        if len(got):
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(got)), pa.array(place[got].astype(np.int32)), pa.array(mask[got]), nothing, nothing], names
            )
        at = np.concatenate(open_at)
        keys = np.concatenate(open_keys)
        if len(at):
            k1, k2 = (tb.combine(list(keys.T), seed).view(np.int64) for seed in (71, 72))
            start = np.concatenate(open_start).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(at)), pa.array(start), pa.array(np.zeros(len(at), np.int32)), pa.array(k1), pa.array(k2)], names
            )

    id_type = suffixes.schema["doc_id"].dataType.simpleString()
    return suffixes.mapInArrow(tb.task(run), f"doc_id {id_type}, place int, mask int, k1 bigint, k2 bigint")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_words, removed, kept_text``.

    ``removed`` are the maximal runs of removed words (start, end); the kept
    words are joined by one space.
    """
    if not GRAM <= window <= GRAM + 31:
        raise ValueError(f"window must be {GRAM} to {GRAM + 31} words")
    given = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = given.schema["doc_id"].dataType.simpleString()
    keyed = docids.keyed(given)
    rows = keyed.select(F.col("doc").alias("doc_id"), "text")
    parts = max(8, 2 * rows.rdd.getNumPartitions())

    def find(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        starts, ends, first = tb.word_spans(buf, offs, tb.SPACELESS)
        place, _, _, grams = suffix_starts(tb.word_hashes(buf, starts, ends), first, window)
        return grams[place]

    bitmap = winnow.repeated(rows.select("text"), find, parts)
    suffixes = _suffixes(rows, bitmap, window)
    lead = F.expr(f"substring(words, back * {_WORD} + 1, {GRAM * _WORD})")
    dealt = suffixes.withColumn("lead", lead).repartitionByRange(parts, "lead", "doc_id", "place").drop("lead")
    marked = stored(_marked(dealt, window), "marks")

    open_rows = marked.filter("k1 IS NOT NULL")
    earliest = open_rows.groupBy("k1", "k2").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place")).alias("first")
    )
    later = open_rows.join(earliest, ["k1", "k2"]).filter(
        ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("place") == F.col("first.place")))
    )
    marks = marked.filter("k1 IS NULL").select("doc_id", "place", "mask").unionByName(
        later.select("doc_id", "place", F.lit(1).alias("mask"))
    )
    by_doc = stored(marks.groupBy("doc_id").agg(F.collect_list(F.struct("place", "mask")).alias("marks")), "by_doc")

    # Texts without a mark never move.
    ids = by_doc.select(F.col("doc_id").alias("m_id"), "marks")
    maybe, surely_not = keyset.split(keyed, "doc", by_doc.select(F.col("doc_id").alias("doc")))
    joined = maybe.join(ids, F.col("doc") == F.col("m_id"), "left").select("doc_id", "text", "marks")
    plain = surely_not.select("doc_id", "text", F.lit(None).cast(ids.schema["marks"].dataType).alias("marks"))
    spans = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, _, _ in tb.chunks(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                counts, removed, kept = [], [], []
                for text, marked in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    edge = np.zeros(len(words) + 1, np.int64)
                    if marked:
                        at = np.array([m["place"] for m in marked])
                        bits = np.array([m["mask"] for m in marked])
                        for i in range(window - GRAM + 1):
                            start = at[(bits >> i) & 1 > 0] - i
                            np.add.at(edge, start, 1)
                            np.add.at(edge, start + window, -1)
                    gone = np.cumsum(edge)[:-1] > 0
                    counts.append(len(words))
                    border = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).astype(np.int8)))
                    removed.append([{"start": int(s), "end": int(e)} for s, e in border.reshape(-1, 2)])
                    kept.append(b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g] if marked else words))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(removed, spans), pa.array([k.decode() for k in kept], pa.string())],
                    ["doc_id", "n_words", "removed", "kept_text"],
                )

    schema = f"doc_id {id_type}, n_words bigint, removed array<struct<start:int,end:int>>, kept_text string"
    return joined.mapInArrow(tb.task(cut), schema).unionByName(plain.mapInArrow(tb.task(cut), schema))
