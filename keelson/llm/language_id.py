"""Language identification by inference of a language mixture.

Learning counts byte trigrams of lower-cased words (with their borders, hashed
to ``GRAMS`` columns) for each language; the counts are plain sums, so a
language that makes up most of the table is combined before the shuffle. The
model has ``languages * GRAMS`` numbers and is broadcast after a check of that
size: an inventory of languages does not grow with the corpus.

Prediction: every word has a likelihood under each language. Expectation
maximisation estimates the languages' shares of a document's words. The set of
languages is chosen by penalised likelihood: the best single language is
compared with the best two, three ... by share, and each further language must
raise the log likelihood by more than ``0.5 * ln(words) + EXTRA``. The
language with the largest share is the prediction and its share the score.

Defined results: a null text, or one without a letter, is ``und`` with score
0, and so is every text if nothing was learned. Null languages are not learned.
Ties go to the language first in alphabetical order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import textbytes as tb

GRAMS = 1 << 16
MAX_MODEL_BYTES = 512 << 20
ROUNDS = 12
EXTRA = 3.0
FLUSH_LANGUAGES = 64
UNKNOWN = "und"

_LETTERS = np.zeros(256, bool)
_LETTERS[97:123] = True
_LETTERS[128:] = True


def _words(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Gram columns of all words' bytes, first byte of each word among them, word offsets by row, word hashes."""
    starts, ends, first = tb.word_spans(raw, offs, _LETTERS)
    lens = ends - starts
    at = np.cumsum(lens) - lens
    within = np.arange(int(lens.sum())) - np.repeat(at, lens)
    place = within + np.repeat(starts, lens)
    mid = raw[place].astype(np.uint64)
    left, right = np.zeros_like(mid), np.zeros_like(mid)
    left[1:], right[:-1] = mid[:-1], mid[1:]
    if len(at):
        left[at] = 32
        right[at[1:] - 1] = 32
        right[-1] = 32
    grams = (tb.mix((left << np.uint64(16)) | (mid << np.uint64(8)) | right) & np.uint64(GRAMS - 1)).astype(np.int64)
    return grams, at, first, tb.word_hashes(raw, starts, ends)


def _lower(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(column, ""))


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, gram, n``: the gram counts of each language."""
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).dropna()

    def out(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(n[some], pa.int64())],
                ["lang", "gram", "n"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lo, hi, raw, offs in tb.chunks(_lower(batch.column(1))):
                grams, at, first, _ = _words(raw, offs)
                ends = np.concatenate((at, [len(grams)]))[first]
                for i in range(hi - lo):
                    if ends[i + 1] > ends[i]:
                        own = counts.setdefault(langs[lo + i], np.zeros(GRAMS, np.int64))
                        own += np.bincount(grams[ends[i] : ends[i + 1]], minlength=GRAMS)
                    if len(counts) > FLUSH_LANGUAGES:
                        yield from out(counts)
                        counts = {}
        yield from out(counts)

    found = rows.mapInArrow(tb.task(run), "lang string, gram int, n bigint")
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def model(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """The languages in order, and the log probability of each gram in each of them."""
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MAX_MODEL_BYTES // (4 * GRAMS) + 1).collect())
    if len(langs) * GRAMS * 4 > MAX_MODEL_BYTES:
        raise ValueError("more languages than a broadcast model may hold")
    number = {lang: i for i, lang in enumerate(langs)}
    table = np.zeros((len(langs), GRAMS))
    for r in counts.toLocalIterator():
        table[number[r["lang"]], r["gram"]] = r["n"]
    table += 0.1
    return langs, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def mixtures(likelihood: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Shares of the languages in each row; ``likelihood`` has the words' log likelihoods, ``off`` word offsets."""
    rows, langs = len(off) - 1, likelihood.shape[1]
    shares = np.zeros((rows, langs))
    n = np.diff(off)
    some = np.flatnonzero(n)
    if not len(some):
        return shares
    top = likelihood.max(1)
    p = np.exp(np.maximum(likelihood - top[:, None], -60.0))
    starts = off[some]

    def fit(p: np.ndarray, top: np.ndarray, starts: np.ndarray, n: np.ndarray, allowed: np.ndarray):
        """Shares and log likelihoods by expectation maximisation within the allowed languages."""
        row = np.repeat(np.arange(len(n)), n)
        share = allowed / allowed.sum(1, keepdims=True)
        for _ in range(ROUNDS):
            joint = p * share[row]
            joint /= np.maximum(joint.sum(1, keepdims=True), 1e-300)
            share = np.add.reduceat(joint, starts, axis=0) / n[:, None]
        total = np.log(np.maximum((p * share[row]).sum(1), 1e-300)) + top
        return share, np.add.reduceat(total, starts)

    whole, best = fit(p, top, starts, n[some], np.ones((len(some), langs)))
    single = np.add.reduceat(likelihood.astype(np.float64), starts, axis=0)
    chosen = np.zeros((len(some), langs))
    pick = single.argmax(1)
    chosen[np.arange(len(some)), pick] = 1.0
    reached = single.max(1)
    price = 0.5 * np.log(np.maximum(n[some], 2)) + EXTRA
    order = np.argsort(-whole, axis=1, kind="stable")
    todo = np.flatnonzero(best - reached > price)
    for size in range(2, langs + 1):
        if not len(todo):
            break
        words = np.concatenate([np.arange(s, s + k) for s, k in zip(starts[todo], n[some][todo], strict=True)])
        count = n[some][todo]
        allowed = np.zeros((len(todo), langs))
        np.put_along_axis(allowed, order[todo, :size], 1.0, axis=1)
        share, total = fit(p[words], top[words], np.cumsum(count) - count, count, allowed)
        better = total - reached[todo] > price[todo]
        chosen[todo[better]] = share[better]
        reached[todo[better]] = total[better]
        todo = todo[better & (best[todo] - total > price[todo])]
    shares[some] = chosen
    return shares


def predict(
    docs: DataFrame, learned: tuple[list[str], np.ndarray], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row: ``doc_id, lang_pred, score, shares`` (language to share, those above 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(learned)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logp = shared.value
        for batch in batches:
            texts = batch.column(1)
            for lo, hi, raw, offs in tb.chunks(_lower(texts)):
                grams, at, first, hashes = _words(raw, offs)
                some, back = np.unique(hashes, return_index=True, return_inverse=True)[1:]
                size = np.diff(np.concatenate((at, [len(grams)])))[some]
                begin = np.cumsum(size) - size
                pick = np.arange(int(size.sum())) - np.repeat(begin, size) + np.repeat(at[some], size)
                picked = grams[pick]
                own = np.zeros((len(some), len(langs)))
                for i in range(len(langs)):
                    if len(some):
                        own[:, i] = np.add.reduceat(logp[i, picked], begin)
                shares = mixtures(own[back], first) if langs else np.zeros((hi - lo, 1))
                ascii_letters = np.zeros(len(raw) + 1, np.int64)
                np.cumsum((raw >= 97) & (raw <= 122), out=ascii_letters[1:])
                plain = np.diff(ascii_letters[offs]) > 0
                part = texts.slice(lo, hi - lo)
                pred, score, kept = [], [], []
                for i in range(hi - lo):
                    best = int(shares[i].argmax())
                    letter = plain[i] or any(c.isalpha() for c in (part[i].as_py() or ""))
                    if not langs or not letter or shares[i, best] <= 0:
                        pred.append(UNKNOWN)
                        score.append(0.0)
                        kept.append([])
                    else:
                        pred.append(langs[best])
                        score.append(float(min(shares[i, best], 1.0)))
                        kept.append([(langs[j], float(shares[i, j])) for j in np.flatnonzero(shares[i])])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(pred, pa.string()),
                        pa.array(score, pa.float64()),
                        pa.array(kept, pa.map_(pa.string(), pa.float64())),
                    ],
                    ["doc_id", "lang_pred", "score", "shares"],
                )

    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(tb.task(run), f"doc_id {id_type}, lang_pred string, score double, shares map<string,double>")
