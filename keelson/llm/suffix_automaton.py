"""Removal of repeated byte spans by matching against suffix automata.

Every byte covered by a ``span``-byte string that also starts in a document
with a smaller id is removed. The references are the documents themselves, so
one automaton of them all would neither fit nor be worth its size: automata
are built of reference shards, each only of text that can repeat.

1. Winnowing (``winnow``) gives every ``span``-byte window an anchor of
   ``GRAM`` bytes, and a fixed-size bitmap says which anchors repeat.
2. Repeated anchors are grouped by a packed shuffle; each is assigned to the
   reference with the smallest id that holds it. All places of one string have
   one anchor, so they meet at one reference.
3. Documents are cut into segments, maximal runs of windows with one
   reference. A shard is the segments of some references. In id order, each
   document is streamed through the shard's suffix automaton of the texts
   before it: the automaton's matching statistics (the longest match that ends
   at each byte) of ``span`` or more mark its bytes, and only text that did not
   match is added. A shard's automaton is thus as large as its distinct text,
   and lives in the one task that streams the shard's documents.
4. A reference with more than ``SHARD_BYTES`` of segments is dealt to several
   automata by a hash of the document. What is new to them goes on to a round
   of at most half as many, until one automaton has seen all that was new.

Defined results: a null text has no bytes; a null id comes after all others;
rows that repeat id and text are one document; rows that share an id (or null)
but not the text are documents of their own, in the order of a digest of their
texts, after all smaller ids (``docids``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm import docids, keyset, winnow
from keelson.llm import textbytes as tb
from keelson.llm.scratch import stored

SPAN = 50
GRAM = 32
SHARD_BYTES = 8 << 20
FLUSH = 1_000_000
CHUNK_BYTES = 1 << 20
_UNDEALT = (1 << 63) - 1
_TABLE = tb.randoms(256, 5)


class SuffixAutomaton:
    """Suffix automaton of several byte strings, grown string by string."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of state ``q`` for the shorter strings that reach it from ``p`` by ``c``."""
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        link[q] = copy
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = copy
            p = link[p]
        return copy

    def add(self, text: bytes) -> None:
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c in text:
            q = nxt[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            state = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0:
                steps = nxt[p]
                if c in steps:
                    break
                steps[c] = state
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[state] = q if length[q] == length[p] + 1 else self._split(p, c, q)
            last = state

    def matches(self, text: bytes, span: int) -> list[tuple[int, int]]:
        """Maximal runs of window starts (first, last) whose ``span`` bytes are in the automaton."""
        nxt, link, length = self.next, self.link, self.length
        found: list[tuple[int, int]] = []
        if len(nxt) == 1:  # nothing to match yet
            return found
        state = matched = 0
        begin = -1  # of the run of window ends that is open
        for i, c in enumerate(text):
            to = nxt[state].get(c)
            if to is not None:
                state = to
                matched += 1
                if matched == span and begin < 0:
                    begin = i
                continue
            while state and c not in nxt[state]:
                state = link[state]
            if c in nxt[state]:
                matched = length[state] + 1
                state = nxt[state][c]
            else:
                matched = 0
            if begin >= 0:
                if matched < span:
                    found.append((begin - span + 1, i - span))
                    begin = -1
            elif matched >= span:
                begin = i
        if begin >= 0:
            found.append((begin - span + 1, len(text) - span))
        return found


class Stream:
    """The texts of a shard so far: their automaton, and those with which a new text begins or ends alike.

    A text that begins with the first ``span`` bytes of an earlier one is
    compared with it directly up to the first difference, and likewise from
    its end; only what lies between goes through the automaton.
    """

    def __init__(self, span: int):
        self.span = span
        self.automaton = SuffixAutomaton()
        self._seen: set[bytes] = set()
        self._heads: dict[bytes, bytes] = {}
        self._tails: dict[bytes, bytes] = {}

    def matches(self, text: bytes) -> list[tuple[int, int]]:
        """Maximal runs of window starts (first, last) whose bytes an earlier text has."""
        n, span = len(text), self.span
        if text in self._seen:
            return [(0, n - span)]
        head, tail = self._heads.get(text[:span]), self._tails.get(text[-span:])
        front = _alike(text, head, False) if head is not None else 0
        back = n - _alike(text, tail, True) if tail is not None else n
        lo, hi = (front - span + 1 if front else 0), (back if back < n else n - span + 1)  # window starts in between
        runs = [(0, front - span)] if front else []
        if lo < hi:
            found = self.automaton.matches(text[lo : hi - 1 + span], span)
            runs += [(lo + first, lo + last) for first, last in found]
        if back < n:
            runs.append((min(back, max(lo, hi)), n - span))
        merged: list[tuple[int, int]] = []
        for first, last in runs:
            if merged and first <= merged[-1][1] + 1:
                merged[-1] = (merged[-1][0], max(last, merged[-1][1]))
            else:
                merged.append((first, last))
        return merged

    def add(self, texts: list[bytes], new: list[bytes]) -> None:
        """``texts`` were streamed; ``new`` are their parts that did not match."""
        self._seen.update(texts)
        for text in texts:
            self._heads[text[: self.span]] = text
            self._tails[text[-self.span :]] = text
        for part in new:
            self.automaton.add(part)


def _alike(a: bytes, b: bytes, from_end: bool) -> int:
    """How many bytes two texts share at their beginning, or end."""
    n = min(len(a), len(b))
    x, y = (np.frombuffer(t, np.uint8) for t in (a, b))
    x, y = (x[::-1][:n], y[::-1][:n]) if from_end else (x[:n], y[:n])
    other = x != y
    at = int(other.argmax())
    return at if other[at] else n


def byte_grams(buf: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A hash of every ``size`` (a power of two) successive bytes."""
    h = _TABLE[buf]
    step = 1
    while step < size:
        h = h[:-step] * np.uint64(0x9E3779B97F4A7C15) + (h[step:] ^ (h[step:] >> np.uint64(29))) if len(h) > step else h[:0]
        step *= 2
    return tb.mix(h) if len(h) else np.zeros(0, np.uint64)


def window_anchors(buf: np.ndarray, offs: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of the windows inside rows: place, first and last window start, fingerprint."""
    grams = byte_grams(buf)
    place = winnow.anchors(grams, span - GRAM + 1)
    inside = np.zeros(len(buf) + 1, np.int32)
    some = np.diff(offs) >= span
    inside[offs[:-1][some]] += 1
    inside[offs[1:][some] - span + 1] -= 1
    starts = np.flatnonzero(np.cumsum(inside)[: len(place)])
    place, a, b = winnow.runs(place[starts], starts)
    return place, a, b, grams[place]


def _packed_anchors(docs: DataFrame, bitmap: np.ndarray, parts: int, span: int) -> DataFrame:
    """``part, prints, docs, places``: the candidate anchors, packed."""
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)

    def emit(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        f, d, p = (np.concatenate([x[i] for x in found]) for i in range(3))
        part = (f % np.uint64(parts)).astype(np.int64)
        order = np.lexsort((p, d, part))
        cut = np.searchsorted(part[order], np.arange(parts + 1))
        f, d, p = f[order], d[order], p[order]
        some = np.flatnonzero(np.diff(cut))
        for lo in range(0, len(some), 32):
            group = some[lo : lo + 32]
            blobs = [[x[cut[i] : cut[i + 1]].tobytes() for i in group] for x in (f, d, p)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(group, pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)], ["part", "prints", "docs", "places"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for lo, _, buf, offs in tb.chunks(batch.column(1), CHUNK_BYTES):
                place, _, _, prints = window_anchors(buf, offs, span)
                some = np.flatnonzero(winnow.in_bitmap(shared.value, prints))
                row = np.searchsorted(offs, place[some], "right") - 1
                found.append((prints[some], ids[row + lo], (place[some] - offs[row]).astype(np.int32)))
                size += len(some)
                if size > FLUSH:
                    yield from emit(found)
                    found, size = [], 0
        if size:
            yield from emit(found)

    return docs.mapInArrow(tb.task(run), "part int, prints binary, docs binary, places binary")


def _flat(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _cuts(sorted_values: np.ndarray) -> np.ndarray:
    """Where the groups of equal values begin, and the end."""
    new = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return np.concatenate(([0], new, [len(sorted_values)])) if len(sorted_values) else np.zeros(1, np.int64)


def _blobs(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    return pa.array([values[x:y].tobytes() for x, y in zip(cut[:-1], cut[1:], strict=True)], pa.binary())


def _assigned(packed: DataFrame, parts: int) -> DataFrame:
    """``doc, places, refs``: of each document its repeated anchors and their references."""

    def assign(table: pa.Table) -> pa.Table:
        f, d, p = _flat(table, "prints", np.uint64), _flat(table, "docs", np.int64), _flat(table, "places", np.int32)
        order = np.lexsort((d, f))
        f, d, p = f[order], d[order], p[order]
        cut = _cuts(f)
        group = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
        least = d[cut[:-1]]
        several = (least != d[cut[1:] - 1])[group]
        d, p, ref = d[several], p[several], least[group][several]
        home = (tb.mix(d.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(home, kind="stable")
        d, p, ref, cut = d[order], p[order], ref[order], _cuts(home[order])
        names = ["home", "docs", "places", "refs"]
        return pa.table([pa.array(home[order][cut[:-1]], pa.int32()), *(_blobs(x, cut) for x in (d, p, ref))], names)

    def gather(table: pa.Table) -> pa.Table:
        d, p, ref = _flat(table, "docs", np.int64), _flat(table, "places", np.int32), _flat(table, "refs", np.int64)
        order = np.lexsort((p, d))
        d, p, ref = d[order], p[order], ref[order]
        cut = _cuts(d)
        return pa.table([pa.array(d[cut[:-1]], pa.int64()), _blobs(p, cut), _blobs(ref, cut)], ["doc", "places", "refs"])

    by_home = packed.groupBy("part").applyInArrow(tb.group(assign), "home int, docs binary, places binary, refs binary")
    return by_home.groupBy("home").applyInArrow(tb.group(gather), "doc bigint, places binary, refs binary")


def _segments(docs: DataFrame, span: int) -> DataFrame:
    """``ref, doc, start, data`` from ``doc, text, places, refs``: runs of windows with one reference."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            places, refs = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for lo, hi, buf, offs in tb.chunks(batch.column(1), CHUNK_BYTES):
                place, a, b, _ = window_anchors(buf, offs, span)
                out: list[tuple[int, int, int, bytes]] = []
                for i in range(lo, hi):
                    at, one = np.unique(np.frombuffer(places[i], np.int32).astype(np.int64) + offs[i - lo], return_index=True)
                    ref, k = np.frombuffer(refs[i], np.int64)[one], np.searchsorted(place, at)
                    first, last = a[k], b[k]
                    new = np.flatnonzero(np.concatenate(([True], (ref[1:] != ref[:-1]) | (first[1:] != last[:-1] + 1))))
                    ends = np.concatenate((new[1:] - 1, [len(at) - 1]))
                    for s, e in zip(new, ends, strict=True):
                        x, y = int(first[s]), int(last[e]) + span
                        out.append((int(ref[s]), int(ids[i]), x - int(offs[i - lo]), buf[x:y].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([o[0] for o in out], pa.int64()),
                            pa.array([o[1] for o in out], pa.int64()),
                            pa.array([o[2] for o in out], pa.int32()),
                            pa.array([o[3] for o in out], pa.binary()),
                        ],
                        ["ref", "doc", "start", "data"],
                    )

    return docs.mapInArrow(tb.task(run), "ref bigint, doc bigint, start int, data binary")


def _streamed(segments: DataFrame, shards: int, span: int) -> DataFrame:
    """Rows without ``data``: bytes ``start .. end`` of ``doc`` to remove. Rows with it: what a dealt reference had new."""
    size = segments.groupBy("ref").agg(F.sum(F.length("data")).alias("bytes"), F.max("deals").alias("before"))
    wanted = F.least(F.ceil(F.col("bytes") / SHARD_BYTES), F.floor(F.col("before") / 2))
    large = size.select("ref", wanted.cast("bigint").alias("now")).filter("now > 1")
    dealt = segments.drop("deals").join(large, "ref", "left").select(
        "ref",
        "doc",
        "start",
        "data",
        F.coalesce("now", F.lit(1)).alias("deals"),
        F.when(F.col("now").isNotNull(), F.pmod(F.xxhash64("doc"), F.col("now"))).otherwise(-1).alias("deal"),
    )
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("ref", "deal"), F.lit(shards)))

    def stream(table: pa.Table) -> pa.Table:
        table = table.sort_by([("ref", "ascending"), ("deal", "ascending"), ("doc", "ascending"), ("start", "ascending")])
        ref, deal, deals, doc, start = (table[c].to_numpy() for c in ("ref", "deal", "deals", "doc", "start"))
        data = table["data"]
        spans: list[tuple[int, int, int]] = []
        fresh: list[tuple[int, int, int, bytes, int]] = []
        earlier, key, n, i = Stream(span), None, len(ref), 0
        while i < n:
            if key != (ref[i], deal[i]):
                key = (ref[i], deal[i])
                earlier = Stream(span)
            j = i
            new: list[tuple[int, bytes]] = []
            texts: list[bytes] = []
            # All segments of a document are streamed before any of them is added.
            while j < n and (ref[j], deal[j]) == key and doc[j] == doc[i]:
                text, at = data[j].as_py(), 0
                for first, last in earlier.matches(text):
                    spans.append((doc[i], int(start[j]) + first, int(start[j]) + last + span))
                    if first > at:
                        new.append((int(start[j]) + at, text[at : first - 1 + span]))
                    at = last + 1
                if at <= len(text) - span:
                    new.append((int(start[j]) + at, text[at:]))
                texts.append(text)
                j += 1
            earlier.add(texts, [text for _, text in new])
            for at, text in new:
                if deal[i] >= 0:
                    fresh.append((ref[i], doc[i], at, text, deals[i]))
            i = j
        rows = [(None, d, s, e, None, None) for d, s, e in spans] + [(r, d, s, None, t, k) for r, d, s, t, k in fresh]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
        names = ["ref", "doc", "start", "end", "data", "deals"]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    schema = "ref bigint, doc bigint, start int, end int, data binary, deals bigint"
    return dealt.groupBy("shard").applyInArrow(tb.group(stream), schema)


def remove_spans(docs: DataFrame, span: int = SPAN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_bytes, removed, kept``.

    ``removed`` are the maximal runs of removed bytes (start, end) of the UTF-8
    text, ``kept`` the other bytes.
    """
    if span < GRAM:
        raise ValueError(f"span must be {GRAM} bytes or more")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    keyed = docids.keyed(rows)
    parts = max(8, rows.rdd.getNumPartitions())

    def find(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        return window_anchors(buf, offs, span)[3]

    bitmap = winnow.repeated(rows.select("text"), find, 2 * parts, CHUNK_BYTES)
    lists = stored(_assigned(_packed_anchors(keyed.select("doc", "text"), bitmap, parts, span), parts), "anchors")
    # A document's repeated rows are one here.
    listed = keyset.split(keyed, "doc", lists.select("doc"))[0].select("doc", "text").join(lists, "doc")
    segments = stored(_segments(listed, span).withColumn("deals", F.lit(_UNDEALT)), "segments")

    found = None
    while True:
        streamed = stored(_streamed(segments, 8 * parts, span), "streamed")
        spans = streamed.filter("data IS NULL").select("doc", "start", "end")
        found = spans if found is None else found.unionByName(spans)
        segments = streamed.filter("data IS NOT NULL").select("ref", "doc", "start", "data", "deals")
        if not segments.limit(1).count():
            break
    marks = stored(
        found.groupBy(F.col("doc").alias("m")).agg(F.collect_list(F.struct("start", "end")).alias("marks")), "spans"
    )
    maybe, surely_not = keyset.split(keyed, "doc", marks.select(F.col("m").alias("doc")))
    joined = maybe.join(marks, F.col("doc") == F.col("m"), "left").select("doc_id", "text", "marks")
    plain = surely_not.select("doc_id", "text", F.lit(None).cast(marks.schema["marks"].dataType).alias("marks"))
    removed_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, buf, offs in tb.chunks(batch.column(1), CHUNK_BYTES):
                marked = batch.column(2).slice(lo, hi - lo)
                removed, kept = [], []
                for i in range(hi - lo):
                    text = buf[offs[i] : offs[i + 1]]
                    spans: list[dict] = []
                    marks = marked[i].as_py()
                    if marks:
                        for s, e in sorted((m["start"], m["end"]) for m in marks):
                            if spans and s <= spans[-1]["end"]:
                                spans[-1]["end"] = max(spans[-1]["end"], e)
                            else:
                                spans.append({"start": s, "end": e})
                        stay = np.ones(len(text), bool)
                        for s in spans:
                            stay[s["start"] : s["end"]] = False
                        text = text[stay]
                    removed.append(spans)
                    kept.append(text.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array(np.diff(offs), pa.int64()),
                        pa.array(removed, removed_type),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "removed", "kept"],
                )

    schema = f"doc_id {id_type}, n_bytes bigint, removed array<struct<start:int,end:int>>, kept binary"
    return joined.mapInArrow(tb.task(cut), schema).unionByName(plain.mapInArrow(tb.task(cut), schema))
