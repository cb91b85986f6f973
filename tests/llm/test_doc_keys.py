"""Repeated, missing and non-integer ids in the operators that order documents by id; clashing names in key sets."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import docids, keyset, queries, suffix_automaton, suffix_dedup
from tests.llm.conftest import WORDS


def order_of(row):
    i, text = row
    return (i is None, i if i is not None else 0, hashlib.md5((text or "").encode()).hexdigest())


def brute_spans(rows, span=50):
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=order_of):
        b = (t or "").encode()
        gone, own = np.zeros(len(b), bool), set()
        for a in range(len(b) - span + 1):
            own.add(b[a : a + span])
            if b[a : a + span] in seen:
                gone[a : a + span] = True
        seen |= own
        out[i, t] = bytes(np.frombuffer(b, np.uint8)[~gone])
    return out


def brute_windows(rows, window=20):
    seen, out = set(), {}
    for i, t in sorted(set(rows), key=order_of):
        w, gone = WORDS.findall(t or ""), set()
        for a in range(len(w) - window + 1):
            key = tuple(w[a : a + window])
            gone.update(range(a, a + window) if key in seen else ())
            seen.add(key)
        out[i, t] = " ".join(x for k, x in enumerate(w) if k not in gone)
    return out


@pytest.fixture(scope="module")
def odd_rows():
    rng = random.Random(7)
    shared = [" ".join(f"s{k}w{j}" for j in range(40)) for k in range(4)]
    own = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(1, 6) + str(rng.randint(0, 99)) for _ in range(30))
    texts = [f"{own()} {rng.choice(shared)} {own()}" for _ in range(40)]
    rows = [(None if k % 3 == 0 else k // 4, t) for k, t in enumerate(texts)]
    return rows + rows[:5] + [(None, None), (None, ""), (3, None), (3, ""), (99, texts[0]), (99, texts[0] + " more")]


@pytest.mark.parametrize("shard", [8 << 20, 1500])
def test_rows_that_share_an_id(spark, odd_rows, shard, monkeypatch):
    monkeypatch.setattr(suffix_automaton, "SHARD_BYTES", shard)
    queries.ship(spark)
    docs = spark.createDataFrame([(*r, "x") for r in odd_rows], "doc_id long, text string, doc string").repartition(4)
    # The result has no text; rows of one id and one length of text have one result here.
    bytes_of, words_of = brute_spans(odd_rows), brute_windows(odd_rows)
    got = sorted((str(r.doc_id), r.n_bytes, bytes(r.kept)) for r in suffix_automaton.remove_spans(docs).collect())
    assert got == sorted((str(i), len((t or "").encode()), bytes_of[i, t]) for i, t in odd_rows)
    if shard > 1500:
        got = sorted((str(r.doc_id), r.n_words, r.kept_text) for r in suffix_dedup.remove_repeats(docs).collect())
        assert got == sorted((str(i), len(WORDS.findall(t or "")), words_of[i, t]) for i, t in odd_rows)


def test_text_ids(spark, odd_rows):
    rows = [(None if i is None else f"id{i:04d}", t) for i, t in odd_rows]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    want = brute_spans([(i if i is None else int(i[2:]), t) for i, t in rows])
    got = sorted((str(r.doc_id), bytes(r.kept)) for r in suffix_automaton.remove_spans(docs).collect())
    assert got == sorted((str(i), want[None if i is None else int(i[2:]), t]) for i, t in rows)


def test_common_phrases_shorter_than_a_span(spark, monkeypatch):
    monkeypatch.setattr(suffix_automaton, "SHARD_BYTES", 2000)
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(30))
    for phrase in ("p" * 5 + "common phrase of 34 bytes, no more", "q" * 9 + "a common phrase of forty-nine bytes here"):
        rows = [(i, f"{word()} {phrase[:49]} {word()}") for i in range(150)]
        rows += [(1000 + i, rows[i][1][10:]) for i in range(10)]
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        want = brute_spans(rows)
        assert {(r.doc_id, bytes(r.kept)) for r in suffix_automaton.remove_spans(docs).collect()} == {(i, want[i, t]) for i, t in rows}


def test_stream_equals_search():
    rng = random.Random(5)
    for _ in range(200):
        base = bytes(rng.choice(b"ab") for _ in range(60))
        earlier, texts = suffix_automaton.Stream(8), []
        for _ in range(6):
            text = bytearray(base[rng.randint(0, 20) : rng.randint(35, 60)])
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(b"abc")
            text = bytes(text)
            windows = {t[a : a + 8] for t in texts for a in range(len(t) - 7)}
            hit = [text[a : a + 8] in windows for a in range(len(text) - 7)]
            got = earlier.matches(text)
            assert [any(f <= a <= e for f, e in got) for a in range(len(hit))] == hit
            assert all(x[1] + 1 < y[0] for x, y in zip(got, got[1:]))
            earlier.add([text], [text])
            texts.append(text)


def test_unique_integers_keep_their_values(spark):
    docs = spark.createDataFrame([(5, "a"), (-2, "b"), (None, "c")], "doc_id int, text string")
    assert {(r.doc_id, r.doc) for r in docids.keyed(docs).collect()} == {(5, 5), (-2, -2), (None, docids.LAST)}


def test_key_sets_with_clashing_names(spark):
    rows = spark.range(50).select(F.col("id").alias("k"), *[F.lit("v").alias(c) for c in ("__bitmap", "__bucket", "__gone", "__Bucket_")])
    drop = spark.range(10, 20).select(F.col("id").alias("k"))
    left = keyset.without(rows, "k", drop)
    assert left.columns == rows.columns and sorted(r.k for r in left.collect()) == [*range(10), *range(20, 50)]
