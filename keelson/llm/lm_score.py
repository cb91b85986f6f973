"""Language-model scoring with a log-frequency Bloom filter.

Training counts words and word pairs (an end token closes each text, and a
text's first token follows its beginning). Each task counts its own n-grams by
hash and sends them, packed, to the part of the hash range they fall in; a
part adds them up. Word counts are kept exactly. Pair counts go into a
log-frequency Bloom filter: a pair seen ``c`` times is inserted with the
levels ``1 .. 1 + floor(log2 c)``, so a count is read back by probing levels
until one is missing. Each part is a slice of the filter with
``BITS_PER_ENTRY`` bits for every entry, so error rates do not depend on size.

Scoring: ``p(w | u) = (n(u, w) + MU * p1(w)) / (c(u) + MU)`` with the count
``n`` read from the filter (the low end of its level, never above the true
count unless a probe errs) and the exact add-one estimate ``p1``.

Words and filter are broadcast if together they are at most
``BROADCAST_BYTES``; beyond that the rows are numbered and cut into blocks of
``BLOCK_BYTES``, the distinct words and pairs of a block go, packed, to their
parts, and the counts and levels found there come back, packed in the same
order, to the block's rows: the same scores. Nothing is cut off at any size.

Defined results: a null text is empty (the end token only); without training
rows all counts are 0. Rows that repeat an id are scored each for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textbytes as tb
from keelson.llm.scratch import stored

BITS_PER_ENTRY = 8
PROBES = 4
MU = 200.0
BROADCAST_BYTES = 384 << 20
FLUSH = 3_000_000
BLOCK_BYTES = 16 << 20
BLOCK_ROWS = 1 << 20
_END, _BEGIN = tb.randoms(2, 4242)
_PART_SEED = np.uint64(0x2545F4914F6CDD1D)


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes (an end token for each row), the hashes of the pairs they end, token offsets by row."""
    buf = tb.LOWER[raw]
    starts, ends, first = tb.word_spans(buf, offs, tb.SPACELESS)
    h = tb.word_hashes(buf, starts, ends)
    off = first + np.arange(len(first))
    seq = np.full(off[-1], _END)
    seq[np.arange(len(h)) + tb.row_of(first)] = h
    before = np.empty_like(seq)
    before[1:] = seq[:-1]
    before[off[:-1]] = _BEGIN
    return seq, before, off


def pair_hash(before: np.ndarray, seq: np.ndarray) -> np.ndarray:
    return tb.combine([before, seq], 31)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """The level of a count: 1 for 1, 2 for 2 and 3, 3 for 4 to 7 ..."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def low_end(levels: np.ndarray) -> np.ndarray:
    return np.where(levels > 0, np.exp2(levels - 1.0), 0.0)


def _slots(h: np.ndarray, level: int, probe: int, bits: np.ndarray) -> np.ndarray:
    """The place of one probe in a slice of ``bits`` bits."""
    salt = (level * 0x9E3779B97F4A7C15 + probe * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF
    return (tb.mix(h + np.uint64(salt)) % bits.astype(np.uint64)).astype(np.int64)


def part_of(h: np.ndarray, parts: int) -> np.ndarray:
    return (tb.mix(h ^ _PART_SEED) % np.uint64(parts)).astype(np.int64)


def _added(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, ascending, with their summed counts."""
    if not len(h):
        return h, n
    order = np.argsort(h)
    h, n = h[order], n[order]
    new = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
    return h[new], np.add.reduceat(n, new)


def _dealt(h: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order that puts hashes by part, within a part as they came, and where each part begins in it."""
    part = part_of(h, parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _partial_counts(docs: DataFrame, parts: int) -> DataFrame:
    """``part, kind, hashes, counts``: packed counts of one task. Kind 0 words, 1 pairs."""

    def packed(kind: int, found: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        h, n = np.unique(np.concatenate(found), return_counts=True)
        order, cut = _dealt(h, parts)
        h, n = h[order], n[order].astype(np.int64)
        some = np.flatnonzero(np.diff(cut))
        for lo in range(0, len(some), 64):
            group = some[lo : lo + 64]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group, pa.int32()),
                    pa.array(np.full(len(group), kind), pa.int32()),
                    pa.array([h[cut[p] : cut[p + 1]].tobytes() for p in group], pa.binary()),
                    pa.array([n[cut[p] : cut[p + 1]].tobytes() for p in group], pa.binary()),
                ],
                ["part", "kind", "hashes", "counts"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, size = [], [], 0
        for batch in batches:
            for _, _, raw, offs in tb.chunks(batch.column(0)):
                seq, before, _ = tokens(raw, offs)
                words.append(seq)
                pairs.append(pair_hash(before, seq))
                size += len(seq)
                if size > FLUSH:
                    yield from packed(0, words)
                    yield from packed(1, pairs)
                    words, pairs, size = [], [], 0
        if size:
            yield from packed(0, words)
            yield from packed(1, pairs)

    return docs.mapInArrow(tb.task(run), "part int, kind int, hashes binary, counts binary")


def _merged(table: pa.Table, kind: int) -> tuple[np.ndarray, np.ndarray]:
    rows = table.filter(pc.equal(table["kind"], kind))
    h = np.frombuffer(b"".join(rows["hashes"].to_pylist()), np.uint64)
    n = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.int64)
    return _added(h, n)


def _slices(partial: DataFrame) -> DataFrame:
    """One row a part: its exact word counts and its slice of the filter."""

    def build(table: pa.Table) -> pa.Table:
        words, seen = _merged(table, 0)
        pairs, counts = _merged(table, 1)
        level = levels_of(counts) if len(counts) else np.zeros(0, np.int64)
        bits = np.zeros(max(64, -(-int(level.sum()) * BITS_PER_ENTRY // 64) * 64), bool)
        size = np.full(1, len(bits))
        for q in range(1, int(level.max(initial=0)) + 1):
            some = pairs[level >= q]
            for probe in range(PROBES):
                bits[_slots(some, q, probe, size)] = True
        return pa.table(
            {
                "part": pa.array([table["part"][0].as_py()], pa.int32()),
                "words": pa.array([words.tobytes()], pa.binary()),
                "counts": pa.array([seen.tobytes()], pa.binary()),
                "filter": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary()),
                "n_words": pa.array([len(words)], pa.int64()),
                "n_tokens": pa.array([int(seen.sum())], pa.int64()),
            }
        )

    schema = "part int, words binary, counts binary, filter binary, n_words bigint, n_tokens bigint"
    return partial.groupBy("part").applyInArrow(tb.group(build), schema)


@dataclass
class Model:
    """Exact word counts and the filter, whole."""

    words: np.ndarray
    counts: np.ndarray
    bits: np.ndarray
    slice_at: np.ndarray  # first bit of each part's slice
    slice_bits: np.ndarray
    n_tokens: int

    def word_counts(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words) or not len(h):
            return np.zeros(len(h), np.int64)
        distinct, back = np.unique(h, return_inverse=True)
        at = np.minimum(np.searchsorted(self.words, distinct), len(self.words) - 1)
        return np.where(self.words[at] == distinct, self.counts[at], 0).astype(np.int64)[back]

    def pair_levels(self, h: np.ndarray) -> np.ndarray:
        """Probe level after level until one is missing."""
        level = np.zeros(len(h), np.int64)
        if not len(self.slice_bits):
            return level
        part = part_of(h, len(self.slice_bits))
        todo = np.flatnonzero(self.slice_bits[part] > 0)
        q = 1
        while len(todo):
            p = part[todo]
            there = np.ones(len(todo), bool)
            for probe in range(PROBES):
                live = np.flatnonzero(there)
                slot = self.slice_at[p[live]] + _slots(h[todo[live]], q, probe, self.slice_bits[p[live]])
                there[live] = (self.bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 > 0
            todo = todo[there]
            level[todo] = q
            q += 1
        return level


def _collected(slices: DataFrame, parts: int) -> Model:
    """The model from its slices, fetched one partition at a time (bounded by BROADCAST_BYTES)."""
    words, counts, bits, n = [], [], [], 0
    sizes = np.zeros(parts, np.int64)
    for r in slices.toLocalIterator():
        words.append(np.frombuffer(bytes(r["words"]), np.uint64))
        counts.append(np.frombuffer(bytes(r["counts"]), np.int64).astype(np.uint32 if r["n_tokens"] < 1 << 32 else np.int64))
        bits.append((r["part"], np.frombuffer(bytes(r["filter"]), np.uint8)))
        sizes[r["part"]] = len(r["filter"]) * 8
        n += r["n_tokens"]
    bits.sort(key=lambda x: x[0])
    flat_words = np.concatenate(words) if words else np.zeros(0, np.uint64)
    order = np.argsort(flat_words)
    flat_counts = (np.concatenate(counts) if counts else np.zeros(0, np.int64))[order]
    flat_bits = np.concatenate([b for _, b in bits]) if bits else np.zeros(0, np.uint8)
    return Model(flat_words[order], flat_counts, flat_bits, np.cumsum(sizes) - sizes, sizes, n)


SCORES = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _scored(
    ids: pa.Array, off: np.ndarray, c: np.ndarray, ends: int, levels: np.ndarray, n_tokens: int, n_words: int, mu: float
) -> pa.RecordBatch:
    """The scores of rows with token offsets ``off`` from the counts and pair levels of their tokens; ``ends`` counts end tokens."""
    context = np.empty_like(c)
    context[1:] = c[:-1]
    context[off[:-1]] = ends  # as many beginnings as ends
    n = np.minimum(low_end(levels), np.minimum(c, context))
    p = (c + 1.0) / (n_tokens + n_words + 1.0)
    base, score = np.log10(p), np.log10((n + mu * p) / (context + mu))
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(np.diff(off), pa.int64()),
            pa.array(np.add.reduceat((c > 0).astype(np.int64), off[:-1])),
            pa.array(np.full(len(ids), n_tokens), pa.int64()),
            pa.array(np.add.reduceat(base, off[:-1])),
            pa.array(np.add.reduceat(score, off[:-1])),
        ],
        ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
    )


def _by_broadcast(rows: DataFrame, model: Model, mu: float) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = shared.value
            for lo, hi, raw, offs in tb.chunks(batch.column(1)):
                seq, before, off = tokens(raw, offs)
                known = m.word_counts(np.concatenate((seq, [_END])))
                levels = m.pair_levels(pair_hash(before, seq))
                yield _scored(batch.column(0).slice(lo, hi - lo), off, known[:-1], known[-1], levels, m.n_tokens, len(m.words), mu)

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tb.task(run), f"doc_id {id_type}, {SCORES}")


def _blocks(rows: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, text, row, block``: rows numbered, consecutive ones in blocks of at most ``block_bytes`` or one text; written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size, held = -1, 0, 0
        for batch in batches:
            number = batch.column(2).to_numpy()
            blocks = np.empty(len(number), np.int64)
            _, offs = tb.text_buffers(batch.column(1))
            for i, n in enumerate(np.diff(offs).tolist()):
                if block < 0 or size + n > block_bytes or held == BLOCK_ROWS:
                    block, size, held = int(number[i]), 0, 0
                size, held = size + n, held + 1
                blocks[i] = block
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks)], ["doc_id", "text", "row", "block"])

    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    id_type = rows.schema["doc_id"].dataType.simpleString()
    blocks = numbered.mapInArrow(tb.task(run), f"doc_id {id_type}, text string, row bigint, block bigint")
    return stored(blocks, "rows", compression="zstd", clean=True)


def _grams(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The token hashes, the hashes of the pairs they end, and token offsets by row."""
    seqs, pairs, counts = [], [], [np.zeros(1, np.int64)]
    for _, _, raw, offs in tb.chunks(texts):
        seq, before, off = tokens(raw, offs)
        seqs.append(seq)
        pairs.append(pair_hash(before, seq))
        counts.append(np.diff(off))
    return np.concatenate(seqs), np.concatenate(pairs), np.cumsum(np.concatenate(counts))


def _asked(keyed: DataFrame, parts: int) -> DataFrame:
    """``part, block, first, words, pairs``: the distinct n-grams of each block, packed, for the part that knows them.

    A block that two tasks read makes two pieces, named by their ``first`` row.
    """

    def packed(block: int, first: int, texts: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        seq, pairs, _ = _grams(pa.chunked_array(texts))
        h, cuts = [], []
        for found in (seq, pairs):
            distinct = np.unique(found)
            order, cut = _dealt(distinct, parts)
            h.append(distinct[order])
            cuts.append(cut)
        some = np.flatnonzero(np.diff(cuts[0]) + np.diff(cuts[1]))
        for lo in range(0, len(some), 64):
            group = some[lo : lo + 64]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(group, pa.int32()),
                    pa.array(np.full(len(group), block), pa.int64()),
                    pa.array(np.full(len(group), first), pa.int64()),
                    *(pa.array([x[cut[p] : cut[p + 1]].tobytes() for p in group], pa.binary()) for x, cut in zip(h, cuts, strict=True)),
                ],
                ["part", "block", "first", "words", "pairs"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first, texts = -1, -1, []
        for batch in batches:
            blocks = batch.column(2).to_numpy()
            cut = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for lo, hi in zip(cut, cut[1:], strict=False):
                if hi > lo and blocks[lo] != block:
                    if texts:
                        yield from packed(block, first, texts)
                    block, first, texts = int(blocks[lo]), batch.column(1)[lo].as_py(), []
                if hi > lo:
                    texts.append(batch.column(0).slice(lo, hi - lo))
        if texts:
            yield from packed(block, first, texts)

    return keyed.select("text", "row", "block").mapInArrow(
        tb.task(run), "part int, block bigint, first bigint, words binary, pairs binary"
    )


def _answers(asked: DataFrame, slices: DataFrame) -> DataFrame:
    """``block, first, part, counts, levels``: what a part knows of the n-grams that each piece asks for, in its order."""

    def look_up(wanted: pa.Table, held: pa.Table) -> pa.Table:
        h = [[np.frombuffer(x, np.uint64) for x in wanted[kind].to_pylist()] for kind in ("words", "pairs")]
        ends = [np.cumsum([0, *map(len, x)]) for x in h]
        words, pairs = (np.concatenate(x) if x else np.zeros(0, np.uint64) for x in h)
        counts, level = np.zeros(len(words), np.int64), np.zeros(len(pairs), np.uint8)
        if len(ends[0]) > 1 and held.num_rows:
            bits = np.frombuffer(held["filter"][0].as_py(), np.uint8)
            known, n = (np.frombuffer(held[c][0].as_py(), t) for c, t in (("words", np.uint64), ("counts", np.int64)))
            one = np.zeros(1, np.int64)
            model = Model(known, n, bits, one, one + 8 * len(bits), 0)
            counts, level = model.word_counts(words), model.pair_levels(pairs).astype(np.uint8)  # levels are at most 64
        found = [
            pa.array([x[lo:hi].tobytes() for lo, hi in zip(end, end[1:], strict=False)], pa.binary())
            for x, end in ((counts, ends[0]), (level, ends[1]))
        ]
        tb.give_back()
        return pa.table([wanted["block"], wanted["first"], wanted["part"], *found], ["block", "first", "part", "counts", "levels"])

    pairs = asked.groupBy("part").cogroup(slices.select("part", "words", "counts", "filter").groupBy("part"))
    return pairs.applyInArrow(look_up, "block bigint, first bigint, part int, counts binary, levels binary")


def _by_parts(keyed: DataFrame, slices: DataFrame, parts: int, total: int, distinct: int, mu: float) -> DataFrame:
    """The same scores for models too large to broadcast: each part is asked once for what a block of rows needs."""
    answers = stored(_answers(_asked(keyed, parts), slices), "answers", compression="zstd", clean=True)
    id_type = keyed.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def known(found: np.ndarray, answer: np.ndarray) -> np.ndarray:
        """The answers, which are by part, for every item of ``found``."""
        seen, back = np.unique(found, return_inverse=True)
        values = np.empty(len(seen), np.int64)
        values[_dealt(seen, parts)[0]] = answer
        return values[back]

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        texts, told = texts.sort_by("row"), told.sort_by([("first", "ascending"), ("part", "ascending")])
        first = told["first"].to_numpy()
        new = np.flatnonzero(np.append(True, first[1:] != first[:-1]))
        begin = [*np.searchsorted(texts["row"].to_numpy(), first[new]).tolist(), texts.num_rows]
        out = []
        for k, (lo, hi) in enumerate(zip(begin, begin[1:], strict=False)):
            mine = told.slice(new[k], (new[k + 1] if k + 1 < len(new) else len(first)) - new[k])
            counts, levels = (np.frombuffer(b"".join(mine[c].to_pylist()), t) for c, t in (("counts", np.int64), ("levels", np.uint8)))
            piece = texts.slice(lo, hi - lo)
            seq, pairs, off = _grams(piece["text"])
            c = known(seq, counts)
            ids = piece["doc_id"].combine_chunks()
            out.append(_scored(ids, off, c, c[-1], known(pairs, levels), total, distinct, mu))  # the last token is an end
        tb.give_back()
        return pa.Table.from_batches(out).select(names)

    both = keyed.groupBy("block").cogroup(answers.groupBy("block"))
    return both.applyInArrow(run, f"doc_id {id_type}, {SCORES}")


def score(
    docs: DataFrame,
    training: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    mu: float = MU,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, n_known, train_tokens, base_score, score``."""
    learn = training.select(F.col(text_col).cast("string").alias("text"))
    parts = max(8, 2 * learn.rdd.getNumPartitions())
    partial = _partial_counts(learn, parts)
    slices = stored(_slices(partial), "filter", clean=True)
    size = slices.agg(
        F.coalesce(F.sum(F.length("words") + F.length("counts") + F.length("filter")), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum("n_words"), F.lit(0)).alias("words"),
        F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"),
    ).first()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if size["bytes"] <= broadcast_bytes:
        return _by_broadcast(rows, _collected(slices, parts), mu)
    return _by_parts(_blocks(rows), slices, parts, size["tokens"], size["words"], mu)
