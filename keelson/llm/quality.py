"""Quality classifier: nearest-neighbour voting among latent-semantic vectors.

Terms of a text are of two kinds. Its wording: words (A-Z lower-cased) and, for
scripts without spaces, characters of three bytes or more and their pairs, hashed
to ``WORDS`` columns. Its shape: trigrams of its characters' classes (letters by
case, digits, white space, every ASCII mark by itself, anything else) hashed to
``TERMS`` columns, and repeats of a word within the next ``LAGS`` words. Both are
weighted by their rarity (TF-IDF) and scaled to unit length before they are put
together (the wording ``WORDING`` times). A bounded sample of labelled texts (``sample`` rows, chosen by a hash of the id)
gives the term weights and the latent-semantic projection (truncated SVD of
the weighted matrix, from its Gram matrix). The sample stays in the tasks: the
driver sees the summed Gram matrix (a column a term) and the projected vectors. These
are broadcast: ``sample * RANK`` floats, whatever the corpus. Every document is projected and its exact
cosines to all labelled vectors are taken as blocked matrix products; the
``NEIGHBOURS`` nearest vote with their similarity as weight.

Defined results: a null text is empty; a text without terms, like one without
a similar neighbour, scores the sample's mean label. Labels that are null are
not learned; contradicting labels of one document all vote.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textbytes as tb
from keelson.llm.scratch import stored

SAMPLE = 6000
TERMS = 2048
LAGS = 8
WORDS = 2048
WORDING = 1.0
SHAPE = TERMS + LAGS  # columns before the words
WIDE = SHAPE + WORDS
RANK = 64
SPARE = 64  # columns beside the wanted ones in the subspace iteration, and its turns at most
MAX_TURNS = 100
NEIGHBOURS = 31
BLOCK_ROWS = 512
# Texts counted at once: a count takes about 70 bytes for each byte of text and 20 for each row and term.
COUNT_BYTES = 1 << 18
COUNT_ROWS = 128
THRESHOLD = 0.3
FIT_TASKS = 6  # tasks that sum the sample, of bounded size
GRAM_ROWS = 128  # rows of the Gram matrix summed and sent as one, and rows of the sample added at once
# Unit vectors are rounded to multiples of 1 / UNIT, so that sums of their products are exact in any order.
UNIT = float(1 << 18)

# Character classes: 0 lower, 1 upper, 2 digit, 3 space, 4 line end, 5 other control, 6 non-ASCII, then each mark.
_CLASS = np.full(256, 5, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[[10, 13]], _CLASS[128:] = 0, 1, 2, 3, 4, 6
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASS[_MARKS] = 7 + np.arange(len(_MARKS))
_SPAN = 7 + len(_MARKS)


def _characters(buf: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and rows of the characters of three bytes or more, and of pairs of neighbouring ones of one text."""
    lead = np.flatnonzero(buf >= 0xE0)  # their first bytes
    size = 3 + (buf[lead] >= 0xF0)
    code = np.zeros(len(lead), np.uint64)
    for i in range(4):
        there = size > i
        code[there] = (code[there] << np.uint64(8)) | buf[lead[there] + i].astype(np.uint64)
    near = np.flatnonzero((lead[:-1] + size[:-1] == lead[1:]) & (row[lead[:-1]] == row[lead[1:]]))
    pairs = tb.combine([code[near], code[near + 1]], 61) if len(near) else code[:0]
    return np.concatenate((tb.mix(code) if len(code) else code, pairs)), np.concatenate((row[lead], row[lead[near]]))


def _leading(gram: np.ndarray, rank: int) -> np.ndarray:
    """The ``rank`` leading eigenvectors, by subspace iteration: its memory is the matrix and a few columns."""
    width = min(len(gram), rank + SPARE)
    basis = np.linalg.qr(np.random.default_rng(RANK).standard_normal((len(gram), width)).astype(np.float32))[0]
    before = np.zeros(width)
    for _ in range(MAX_TURNS):
        basis, r = np.linalg.qr(gram @ basis)
        now = np.sort(np.abs(np.diag(r)))[::-1][:rank]
        if np.allclose(now, before[:rank], rtol=1e-5, atol=1e-6):
            break
        before = now
    inner = np.linalg.eigh(basis.T @ (gram @ basis))[1][:, ::-1][:, :rank]
    return basis @ inner


def unit_rows(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weighted rows of unit length, made of a shape part and a wording part of fixed shares."""
    x = np.sqrt(counts) * weights
    for part, share in ((slice(0, SHAPE), 1.0), (slice(SHAPE, WIDE), WORDING)):
        x[:, part] *= share / np.maximum(np.linalg.norm(x[:, part], axis=1, keepdims=True), 1e-12)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def term_counts(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Counts of every term for each row (``WIDE`` columns: shape, repeats, words)."""
    rows = len(offs) - 1
    wide = WIDE
    row = tb.row_of(offs)
    c = _CLASS[buf]
    out = np.zeros(rows * wide, np.float32)
    if len(c) >= 3:
        code = (c[:-2] * _SPAN + c[1:-1]) * _SPAN + c[2:]
        term = (tb.mix(code.astype(np.uint64)) >> np.uint64(64 - (TERMS.bit_length() - 1))).astype(np.int64)
        same = row[2:] == row[:-2]
        out += np.bincount((row[:-2] * wide + term)[same], minlength=rows * wide)
    starts, ends, first = tb.word_spans(buf, offs, tb.SPACELESS)
    h = tb.word_hashes(buf, starts, ends)
    word_row = tb.row_of(first)
    low = tb.word_hashes(tb.LOWER[buf], starts, ends)
    out += np.bincount(word_row * wide + SHAPE + (low % np.uint64(WORDS)).astype(np.int64), minlength=rows * wide)
    char, char_row = _characters(buf, row)
    out += np.bincount(char_row * wide + SHAPE + (char % np.uint64(WORDS)).astype(np.int64), minlength=rows * wide)
    for lag in range(1, LAGS + 1):
        again = np.flatnonzero((h[lag:] == h[:-lag]) & (word_row[lag:] == word_row[:-lag]))
        out += np.bincount(word_row[again] * wide + TERMS + lag - 1, minlength=rows * wide)
    return out.reshape(rows, wide)


@dataclass
class Model:
    """Term weights, projection, labelled vectors (unit length) and their labels."""

    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        x = unit_rows(counts, self.weights) @ self.projection
        return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)

    def score(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.prior)
        out = np.empty(len(counts))
        k = min(NEIGHBOURS, len(self.labels))
        for lo in range(0, len(counts), BLOCK_ROWS):
            cosine = self.project(counts[lo : lo + BLOCK_ROWS]) @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            # The distance to a perfect match sharpens the vote of the closest.
            weight = np.maximum(np.take_along_axis(cosine, near, 1).astype(np.float64), 0.0) ** 8
            total = weight.sum(1)
            vote = (weight * self.labels[near]).sum(1)
            out[lo : lo + BLOCK_ROWS] = np.where(total > 1e-9, vote / np.maximum(total, 1e-9), self.prior)
        return out


def _counted(rows: DataFrame, key: str) -> DataFrame:
    """``key, label, terms`` of labelled texts; terms as bytes of float32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in tb.chunks(batch.column(2), COUNT_BYTES, COUNT_ROWS):
                counts = term_counts(buf, offs)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r.tobytes() for r in counts], pa.binary())],
                    [key, "label", "terms"],
                )

    return rows.mapInArrow(tb.task(run), f"{key} {rows.schema[key].dataType.simpleString()}, label double, terms binary")


def fit(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from ``labelled (id_col, label)``: at most ``sample`` rows, the first by a hash of the id."""
    wanted = (
        labelled.select(F.col(id_col).alias("key"), F.col("label").cast("double").alias("label"))
        .dropna()
        .orderBy(F.xxhash64("key", F.lit(17)), "key", "label")
        .limit(sample)
    )
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    rows = texts.join(F.broadcast(wanted), "key").select("key", "label", "text")
    counted = stored(_counted(rows, "key"), "quality-sample").coalesce(FIT_TASKS)
    wide = WIDE
    n, seen = 0, np.zeros(wide, np.int64)
    for r in counted.select("terms").mapInArrow(tb.task(_frequencies), "n bigint, seen binary").collect():
        n, seen = n + r["n"], seen + np.frombuffer(r["seen"], np.int64)
    if not n:
        return Model(np.ones(wide, np.float32), np.zeros((wide, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    weights = np.log((1 + n) / (1 + seen)).astype(np.float32) + 1
    vectors = _leading(_gram(counted, weights), min(RANK, n))
    model = Model(weights, np.ascontiguousarray(vectors), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    del vectors
    labels, model.vectors = _projected(counted, model)
    model.labels, model.prior = labels, float(labels.mean())
    tb.give_back()
    return model


def _blocks(batches: Iterator[pa.RecordBatch], at: int = 0, rows: int = BLOCK_ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of ``rows`` rows at most, and the counts in their column ``at``."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            part = batch.slice(lo, rows)
            yield part, np.frombuffer(b"".join(part.column(at).to_pylist()), np.float32).reshape(part.num_rows, -1)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task, and for each term how many of them have it."""
    n, seen = 0, np.zeros(WIDE, np.int64)
    for part, x in _blocks(batches):
        n, seen = n + part.num_rows, seen + (x > 0).sum(0)
    yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([seen.tobytes()], pa.binary())], ["n", "seen"])


def _gram(counted: DataFrame, weights: np.ndarray) -> np.ndarray:
    """The Gram matrix of the weighted unit rows, summed in tasks by blocks of its rows.

    A block goes from the diagonal on: the matrix is symmetric to the last bit, as the sums are exact.
    """
    wide = len(weights)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = {at: np.zeros((min(GRAM_ROWS, wide - at), wide - at)) for at in range(0, wide, GRAM_ROWS)}
        for _, x in _blocks(batches, rows=GRAM_ROWS):
            unit = np.rint(unit_rows(x, weights) * UNIT).astype(np.float64)
            for at, block in blocks.items():
                block += unit[:, at : at + GRAM_ROWS].T @ unit[:, at:]
        while blocks:
            at, block = blocks.popitem()
            columns = [pa.array([at], pa.int32()), pa.array([block.tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["at", "block"])

    def total(group: pa.Table) -> pa.Table:
        block = sum(np.frombuffer(b.as_py(), np.float64) for b in group.column("block"))
        block = (block / UNIT**2).astype(np.float32)
        return pa.table({"at": group.column("at")[:1], "block": pa.array([block.tobytes()], pa.binary())})

    schema = "at int, block binary"
    parts = counted.select("terms").mapInArrow(tb.task(products), schema)
    gram = np.zeros((wide, wide), np.float32)
    for r in parts.groupBy("at").applyInArrow(tb.group(total), schema).coalesce(FIT_TASKS).toLocalIterator():
        at, end = r["at"], r["at"] + GRAM_ROWS
        block = np.frombuffer(r["block"], np.float32).reshape(-1, wide - at)
        gram[at:end, at:], gram[at:, at:end] = block, block.T
    return gram


def _projected(counted: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Labels and vectors of the sample, by key."""
    shared = counted.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _blocks(batches, 2):
            vectors = pa.array([v.tobytes() for v in shared.value.project(x)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), vectors], ["key", "label", "vector"])

    schema = f"key {counted.schema['key'].dataType.simpleString()}, label double, vector binary"
    rows = counted.mapInArrow(tb.task(run), schema).collect()
    rows.sort(key=lambda r: (r["key"], r["label"], r["vector"]))
    vectors = np.frombuffer(b"".join(r["vector"] for r in rows), np.float32).reshape(len(rows), -1)
    return np.array([r["label"] for r in rows]), vectors


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, score`` (0 to 1, the likelihood of label 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in tb.chunks(batch.column(1), COUNT_BYTES, COUNT_ROWS):
                scores = shared.value.score(term_counts(buf, offs))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(scores)], ["doc_id", "score"])

    return rows.mapInArrow(tb.task(run), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text scores ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in tb.chunks(batch.column(at), COUNT_BYTES, COUNT_ROWS):
                good = shared.value.score(term_counts(buf, offs)) >= threshold
                yield batch.slice(lo, hi - lo).filter(pa.array(good))

    return docs.mapInArrow(tb.task(run), docs.schema)
