"""Best-fit packing: pieces against the tokenizer itself, slots against the rules of a packing."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from keelson.llm import best_fit, queries
from keelson.llm.word_tokens import WordEncoder, _confirmed
from tests.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    loaded = Tokenizer.from_file(PATH)
    loaded.encode_special_tokens = True
    return loaded


def brute_pieces(rows, tokenizer, capacity):
    out = []
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            out.append((doc, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    return out


def check_slots(rows, capacity):
    used = defaultdict(list)
    for r in rows:
        used[r.sequence_id].append((r.offset, r.length))
    for slots in used.values():
        at = 0
        for offset, length in sorted(slots):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


def first_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        fit = min((r for r in room if r >= n), default=None)
        if fit is None:
            room.append(capacity - n)
        else:
            room[room.index(fit)] -= n
    return len(room)


@pytest.mark.parametrize("capacity", [64, 2048])
def test_pieces_and_slots(spark, awkward, plain, capacity):
    queries.ship(spark)
    for docs in (awkward, spark.read.parquet(f"{SMALL}/documents.parquet")):
        want = brute_pieces([(r.doc_id, r.text) for r in docs.collect()], plain, capacity)
        got = best_fit.pack(best_fit.pieces(docs, PATH, capacity, with_ids=True), capacity).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == Counter(want)
        assert all(zlib.crc32(r.token_ids) == r.ids_crc32 and len(r.token_ids) == 4 * r.length for r in got)
        # As few sequences as best fit, one document after the other, needs.
        assert check_slots(got, capacity) == first_fit([w[3] for w in want], capacity)


def test_one_length_holds_most_rows(spark):
    docs = spark.createDataFrame([(i, "same words here" if i % 3 else f"w{i} " * (i % 40)) for i in range(3000)], "doc_id long, text string")
    got = best_fit.pack(best_fit.pieces(docs.repartition(5), PATH, 100), 100).collect()
    assert len({r.doc_id for r in got}) == 3000
    assert check_slots(got, 100) == first_fit([r.length for r in got], 100)


def test_empty_table(spark, empty):
    assert best_fit.pack(best_fit.pieces(empty, PATH)).collect() == []


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, 6, "x")], "doc_id int, text string, length int, offset long, part string")
    (row,) = best_fit.pack(best_fit.pieces(docs, PATH)).collect()
    assert (row.doc_id, row.length, row.offset) == (1, 3, 0)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 50), min_size=1), st.integers(30, 60))
def test_plan_equals_best_fit_one_by_one(counts, capacity):
    plan = best_fit.Plan(counts, capacity)
    fill = defaultdict(list)
    for length, n in counts.items():
        for q, o in zip(*plan.slots(length, np.arange(n))):
            fill[q].append((o, length))
    for slots in fill.values():
        at = 0
        for o, length in sorted(slots):
            assert o == at
            at += length
        assert at <= capacity
    assert len(fill) == plan.sequences == first_fit([k for k, n in counts.items() for _ in range(n)], capacity)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from("aé'st1 \n\t 　Σσ́<|endofx>!"), max_size=40), max_size=6))
def test_words_encode_as_whole_texts(texts):
    import pyarrow as pa

    from keelson.llm.textbytes import text_buffers

    texts = [*texts, "a <|endoftext|>b", None]
    with open(PATH, encoding="utf-8") as f:
        encoder = WordEncoder(f.read())
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    ids, place = encoder.encode(*text_buffers(pa.array(texts, pa.string())))
    for k, t in enumerate(texts):
        assert ids[place[k] : place[k + 1]].tolist() == plain.encode(t or "", add_special_tokens=False).ids


def test_words_with_one_hash_are_told_apart():
    buf = np.frombuffer(b"aa bb aa cc bbb", np.uint8)
    starts, ends = np.array([0, 3, 6, 9, 12]), np.array([2, 5, 8, 11, 15])
    shown, group = _confirmed(buf, starts, ends, np.array([0]), np.zeros(5, np.int64))
    words = [bytes(buf[starts[s] : ends[s]]) for s in shown]
    assert [words[g] for g in group] == [b"aa", b"bb", b"aa", b"cc", b"bbb"]


def test_plain_words_go_by_their_pieces(plain):
    import pyarrow as pa

    from keelson.llm.textbytes import text_buffers

    with open(PATH, encoding="utf-8") as f:
        encoder = WordEncoder(f.read())
    words = ["Maison,", "l'Été's", "O'Neill'LL", "x2y34z", "</w>", "ÀÖØß×÷ÿ", "İi", "éa", "naïve--naïve", "\x00a", "²b", "<|endoftext|>", "Σας", "a" * 300]
    sent = []
    learn = encoder._learn
    encoder._learn = lambda part: (sent.extend(part), learn(part))
    text = " ".join(words * 2)
    ids, _ = encoder.encode(*text_buffers(pa.array([text, text])))
    assert ids.tolist() == 2 * plain.encode(text, add_special_tokens=False).ids
    # Only words with other characters than ASCII and Latin letters go to the tokenizer whole.
    assert {w.decode() for w in sent} == {"ÀÖØß×÷ÿ", "İi", "éa", "\x00a", "²b", "Σας"}


def test_long_words_that_share_eight_bytes():
    from keelson.llm.word_tokens import _block_hashes, _grouped

    text = b"abcdefgh abcdefghi abcdefgh abcdefghij" + b" " + b"z" * 40 + b" " + b"z" * 39 + b"y " + b"z" * 40
    words = text.split()
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    buf = np.frombuffer(text, np.uint8)
    shown, group = _grouped(_block_hashes(buf, starts, ends))
    assert [words[shown[g]] for g in group] == words and len(shown) == 5
    # Of one group, whatever the hash: the bytes behind the eighth decide.
    shown, group = _confirmed(buf, starts, ends, np.array([0, 4]), np.array([0, 0, 0, 0, 1, 1, 1]))
    assert [words[shown[g]] for g in group] == words
