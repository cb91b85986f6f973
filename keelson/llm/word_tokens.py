"""Token ids of whole texts by a public word-piece vocabulary, each distinct word of a chunk encoded once.

Nothing in such a tokenizer (normaliser, splitting pattern, merges) reaches
across white space, so a text's ids are its words' ids in order. The words of
a chunk are found and grouped with numpy; equal hashes are confirmed byte by
byte, and only one word of each group goes to the tokenizer.

A word like ``Maison,`` is pieces to such a tokenizer (``maison`` and ``,``), and
there are fewer different pieces than words. Where the normaliser and the
splitting pattern are known ones, words of ASCII and Latin letters are
lower-cased and split here, and only pieces not seen lately go to the model.
"""

from __future__ import annotations

import functools
import json
import os
import re

import numpy as np
import pyarrow as pa
import regex

from keelson.llm.textbytes import SPACELESS, U64, mix, word_spans

#: Words in each of the two generations that a worker remembers.
CACHE_WORDS = 300_000
#: Pieces of words that a worker remembers.
CACHE_PIECES = 300_000

#: Characters that every Unicode version lower-cases, composes and classes alike; \n parts words.
_NOT_PLAIN = re.compile("[^\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]").search


@functools.lru_cache(maxsize=2)
def word_encoder(spec: str) -> WordEncoder:
    """The encoder of this Python worker, which outlives a task."""
    return WordEncoder(spec)


class WordEncoder:
    """Ids of texts by a tokenizer's JSON, with a bounded memory of words seen before.

    A word found in the old generation moves to the new one; when that is full
    it becomes the old one, so frequent words are kept and rare ones go.
    """

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(spec)
        self._special = [t.content.encode() for t in self._tokenizer.get_added_tokens_decoder().values() if t.special]
        self._known: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._pieces = Pieces.of(self._tokenizer, json.loads(spec))

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each of these different words."""
        if len(self._known) > CACHE_WORDS:
            self._known, self._old = {}, self._known
        known, old = self._known, self._old
        new = [w for w in words if w not in known]
        if old:
            known.update((w, old[w]) for w in new if w in old)
            new = [w for w in new if w not in old]
        for at in range(0, len(new), 64 * 256):
            part = new[at : at + 64 * 256]
            if self._pieces:
                part = self._pieces.learn(part, known)
            if part:
                self._learn(part)
        return [known[w] for w in words]

    def _learn(self, words: list[bytes]) -> None:
        """Encode words in runs: the id of a special token, which no plain word has, marks their ends."""
        whole, joined = words if self._special else [], b"\n".join(words)
        if any(s in joined for s in self._special):
            whole = [w for w in words if not any(s in w for s in self._special)]
        if whole:
            mark, cut = self._special[0], self._tokenizer.token_to_id(self._special[0].decode())
            self._tokenizer.encode_special_tokens = False
            runs = [(mark.join(whole[i : i + 64]) + mark).decode() for i in range(0, len(whole), 64)]
            ids = np.concatenate([np.array(e.ids, "<u4") for e in self._tokenizer.encode_batch_fast(runs, add_special_tokens=False)])
            stop = np.flatnonzero(ids == cut)
            flat, stop = ids.tobytes(), (4 * stop).tolist()
            begin = [0, *(s + 4 for s in stop[:-1])]
            self._known.update((w, flat[a:b]) for w, a, b in zip(whole, begin, stop, strict=True))
        rest = [w for w in words if w not in self._known]
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        for w, e in zip(rest, self._tokenizer.encode_batch([w.decode() for w in rest], add_special_tokens=False)):
            self._known[w] = np.array(e.ids, "<u4").tobytes()

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids (uint32) of all texts of a chunk, and each text's place among them."""
        starts, ends, first = word_spans(buf, offs, SPACELESS)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        shown, group = _grouped(_block_hashes(buf, starts, ends))
        shown, group = _confirmed(buf, starts, ends, shown, group)
        raw = buf.tobytes()
        coded = self._ids_of([raw[a:b] for a, b in zip(starts[shown].tolist(), ends[shown].tolist())])
        flat = np.frombuffer(b"".join(coded), "<u4")
        size = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        begin = np.cumsum(size) - size
        sizes = size[group]
        places = np.cumsum(sizes) - sizes
        total = int(sizes.sum())
        at = np.arange(total, dtype=np.int64) + np.repeat(begin[group] - places, sizes)
        word_place = np.append(places, total)
        return flat[at], word_place[first]


class Pieces:
    """Ids of plain words by their pieces, for tokenizers that lower-case, split by a pattern and mark a piece's end."""

    NORMALIZERS = [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
    ]
    BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}

    def __init__(self, model, pattern: str, end: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._split = regex.compile(pattern).findall
        self._model = Tokenizer(model)
        self._model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self._model.get_vocab()
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for t, i in vocabulary.items() if t.endswith(end)]] = True
        self._ids: dict[str, bytes] = {}

    @classmethod
    def of(cls, tokenizer, spec: dict) -> Pieces | None:
        """None where the tokenizer's steps are others."""
        normalizer, splitter, model = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}, spec["model"]
        steps = splitter.get("pretokenizers", [])
        known = (
            model["type"] == "BPE" and model.get("end_of_word_suffix") and not model.get("dropout")
            and normalizer.get("type") == "Sequence" and normalizer["normalizers"] == cls.NORMALIZERS
            and [p["type"] for p in steps] == ["Split", "ByteLevel"] and cls.BYTES.items() <= steps[1].items()
            and "Regex" in steps[0]["pattern"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        )
        return cls(tokenizer.model, steps[0]["pattern"]["Regex"], model["end_of_word_suffix"]) if known else None

    def learn(self, words: list[bytes], into: dict[bytes, bytes]) -> list[bytes]:
        """Put the ids of the plain words into ``into``; the others are returned."""
        other = []
        text = b"\n".join(words).decode()
        if _NOT_PLAIN(text):
            other = [w for w in words if _NOT_PLAIN(w.decode())]
            without = set(other)
            words = [w for w in words if w not in without]
            text = b"\n".join(words).decode()
        if not words:
            return other
        split = [[w] if w.isalpha() else self._split(w) for w in text.lower().split("\n")]
        if len(self._ids) > CACHE_PIECES:
            self._ids = {}
        new = [*set().union(*split).difference(self._ids)]
        for at in range(0, len(new), 256):
            self._encode(new[at : at + 256])
        ids = self._ids.__getitem__
        into.update(zip(words, [ids(p[0]) if len(p) == 1 else b"".join(map(ids, p)) for p in split]))
        return other

    def _encode(self, pieces: list[str]) -> None:
        ids = np.array(self._model.encode_batch_fast([" ".join(pieces)], add_special_tokens=False)[0].ids, "<u4")
        stop = np.flatnonzero(self._ends[ids]) + 1
        if len(stop) == len(pieces) and stop[-1] == len(ids):
            flat, stop = ids.tobytes(), (4 * stop).tolist()
            self._ids.update(zip(pieces, (flat[a:b] for a, b in zip([0, *stop], stop))))
        else:  # a token in the middle of a piece looks like an end
            for p in pieces:
                self._ids[p] = np.array(self._model.encode(p, add_special_tokens=False).ids, "<u4").tobytes()


def _eight(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on (zeros behind the end), as one number."""
    return np.ndarray(len(buf) + 1, "<u8", np.append(buf, np.zeros(8, np.uint8)), strides=(1,))


def _block_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    eight, lens = _eight(buf), ends - starts
    hashes = mix(lens)
    rest, at = np.arange(len(lens)), 0
    while len(rest):
        left = lens[rest] - at
        block = eight[starts[rest] + at] << (8 * np.maximum(8 - left, 0)).astype(U64)
        hashes[rest] = mix(hashes[rest] ^ block)
        rest, at = rest[left > 8], at + 8
    return hashes


def _grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place where each different hash is seen first, and for each hash which of them it is."""
    group = pa.array(hashes).dictionary_encode().indices.to_numpy()
    shown = np.zeros(int(group.max()) + 1, np.int64)
    shown[group[::-1]] = np.arange(len(group))[::-1]
    return shown, group


def _confirmed(buf, starts, ends, shown, group):
    """The groups without words that share a hash only; those become groups of their own."""
    lens = ends - starts
    model = shown[group]
    same = lens == lens[model]
    eight = _eight(buf)
    rest, at = np.flatnonzero(same & (model != np.arange(len(model)))), 0
    while len(rest):
        left = lens[rest] - at
        differ = eight[starts[rest] + at] ^ eight[starts[model[rest]] + at]
        differ <<= (8 * np.maximum(8 - left, 0)).astype(U64)
        same[rest[differ != 0]] = False
        rest, at = rest[(differ == 0) & (left > 8)], at + 8
    odd = np.flatnonzero(~same)
    if len(odd):
        group = group.copy()
        group[odd] = len(shown) + np.arange(len(odd))
        shown = np.append(shown, odd)
    return shown, group
