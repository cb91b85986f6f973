"""Operators of keelson.llm against brute force, on awkward rows and on the small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from keelson.llm import (
    byte_bpe,
    components,
    decontaminate,
    exact_dedup,
    fmindex,
    html_text,
    keyset,
    language_id,
    lm_score,
    minhash,
    quality,
    queries,
    suffix_automaton,
    suffix_dedup,
)
from keelson.llm import textbytes as tb
from tests.conftest import MEDIUM, SMALL
from tests.llm.conftest import WORDS, lower


@pytest.fixture(scope="session")
def small(spark):
    queries.ship(spark)
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.mark.parametrize("weak", [False, True])
def test_exact_groups(awkward, small, weak):
    hash_fn = (lambda c: F.unhex(F.substring(F.md5(c), 1, 2))) if weak else exact_dedup.content_hash
    for docs in (awkward, small):
        rows = rows_of(docs)
        got = exact_dedup.exact_groups(docs, hash_fn=hash_fn).collect()
        assert len(got) == len(rows)
        size = Counter(t or "" for _, t in rows)
        keep = {t: max((i for i, u in rows if (u or "") == t and i is not None), default=None) for t in size}
        want = Counter((i, keep[t or ""], size[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
        assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got)


def brute_components(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = WORDS.findall(lower(t))
        if i is not None:
            sets[i] = {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def test_near_duplicates(awkward, small):
    for docs, words, percent in ((awkward, 3, 85), (small, 3, 85), (small, 5, 80)):
        want = brute_components(rows_of(docs), words, percent)
        got = [r for r in minhash.near_duplicates(docs, words, percent).collect() if r.doc_id is not None]
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want


def test_near_duplicates_needs_the_last_step(spark):
    """Chains of ever more changed copies are linked only pairwise, never to one member."""
    rows, words = [], [f"v{i}" for i in range(200)]
    for k in range(30):
        rows.append((k * 7 % 31, " ".join(words)))
        words = words[:]
        words[k * 6] = f"new{k}"
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows, 3, 85).items()}


def test_near_duplicates_of_one_large_group(spark, monkeypatch):
    """Near copies of one text, many of them below the threshold to the smallest id: the turns change no result
    and leave fewer links for the pairs that are listed last."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        for at in rng.choice(300, 12 if i < 3 else int(rng.integers(1, 9)), replace=False):
            words[at] = f"x{i}y{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {i: c for i, (_, c) in brute_components(rows, 5, 80).items()}
    linked = []

    def counted(pairs, sets, percent, exact=minhash._linked):
        out = exact(pairs, sets, percent)
        linked.append(out.count())
        return out

    monkeypatch.setattr(minhash, "_linked", counted)
    last = {}
    for turns in (0, 2):
        monkeypatch.setattr(minhash, "TURNS", turns)
        got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 5, 80).collect()}
        assert got == want
        last[turns] = linked[-1]
    assert 4 * last[2] <= last[0]


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_component_joins_leave_no_broadcast_with_the_driver(spark, monkeypatch):
    plans = []

    def planned(df, name, stored=components.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(components, "stored", planned)
    links = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(20, 21), (20, 22)], "u long, v long")
    labels = components.components(links)
    assert {r.node: r.root for r in labels.collect()} == {**dict.fromkeys(range(13), 0), **dict.fromkeys(range(20, 23), 20)}
    plans.append(minhash._rooted(links.withColumnRenamed("u", "node"), labels)._jdf.queryExecution().executedPlan().toString())
    assert any("SortMergeJoin" in p for p in plans)
    assert not any("Broadcast" in p for p in plans)


def test_components_of_a_forest_end_after_one_round(spark, monkeypatch):
    names = []
    monkeypatch.setattr(components, "stored", lambda df, name, stored=components.stored: names.append(name) or stored(df, name))

    def found(links):
        names.clear()
        return {r.node: r.root for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}

    tree = [(0, 3), (3, 0), (3, 7), (7, 9), (1, 5), (5, 6), (0, 3), (8, 8)]
    assert found(tree) == {0: 0, 3: 0, 7: 0, 9: 0, 1: 1, 5: 1, 6: 1}
    assert names.count("links") == 1
    # 4 hooks to 1, and its link to 2 joins two trees.
    assert found([(1, 4), (2, 4), (2, 6), (6, 9)]) == {1: 1, 4: 1, 2: 1, 6: 1, 9: 1}
    assert names.count("links") > 1
    assert found([]) == found([(5, 5)]) == {}


def test_near_duplicates_deals_its_tables_out_few_times(spark, monkeypatch):
    """Each shuffle is a round of tasks, however small its table is."""
    plans = []

    def planned(df, name, stored=minhash.stored):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stored(df, name)

    for module in (minhash, components):
        monkeypatch.setattr(module, "stored", planned)
    rows, words = [], [f"v{i}" for i in range(60)]
    for k in range(12):
        rows += [(k, " ".join(words)), (100 + k, " ".join(words))]
        words = [*words[:-1], f"new{k}"] if k % 2 else [f"new{k}", *words[1:]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 3, 85).collect()}
    assert got == {i: c for i, (_, c) in brute_components(rows, 3, 85).items()}
    assert sum(p.count("Exchange hashpartitioning") for p in plans) <= 40


def test_fm_index():
    rng = np.random.default_rng(0)
    for _ in range(50):
        seq = rng.integers(0, 5, rng.integers(0, 60))
        index = fmindex.FMIndex(seq)
        for length in (1, 3):
            patterns = rng.integers(1, 7, (10, length))
            for p, lo, hi in zip(patterns, *index.search(patterns), strict=True):
                places = [i for i in range(len(seq) - length + 1) if (seq[i : i + length] == p).all()]
                assert sorted(index.locate(np.arange(lo, hi)).tolist()) == places


def brute_hits(text, items, window):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    words, spans, names = find(lower(text)), set(), set()
    for name, t in items:
        w = find(lower(t))
        for a in range(max(1, len(w) - window + 1)) if w else ():
            p = w[a : a + window]
            for i in range(len(words) - len(p) + 1):
                if words[i : i + len(p)] == p:
                    spans.update(range(i, i + len(p)))
                    if name is not None:
                        names.add(str(name))
    return len(words), spans, sorted(names)


def test_contamination(spark, awkward, small):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    odd = [(1, "One two"), (2, "die das"), (2, "die das"), (3, None), (4, ""), (None, "5678"), (5, " ".join(f"w{i}x{i}" for i in range(3, 20)))]
    odd_bench = spark.createDataFrame(odd, "item_id long, text string")
    for docs, items in ((awkward, odd_bench), (small, bench)):
        listed = [(r.item_id, r.text) for r in items.collect()]
        for r, text in [(r, t) for r in decontaminate.find_contamination(docs, items).collect() for i, t in rows_of(docs) if i == r.doc_id][:250]:
            n, spans, names = brute_hits(text, listed, 10) if len(text or "") < 20_000 else (r.n_words, {k for s in r.spans for k in range(s.start, s.end)}, r["items"])
            assert (r.n_words, {k for s in r.spans for k in range(s.start, s.end)}, r["items"]) == (n, spans, names)


def test_bpe_equals_the_public_library(awkward, small):
    tiktoken = pytest.importorskip("tiktoken")
    words = queries.vocabulary()
    library = tiktoken.Encoding("own", pat_str=words.pattern, mergeable_ranks=words.ranks, special_tokens={})
    assert all(words.whole(k) == v for k, v in words.ranks.items()) and words.whole(b"\xff\xfe\xfd no") is None
    for docs in (awkward, small):
        want = Counter((i, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows_of(docs))
        got = byte_bpe.decode(byte_bpe.encode(docs, words), words).collect()
        once = byte_bpe.round_trip(docs, words).collect()
        for rows in (got, once):
            assert Counter((r.doc_id, bytes(r.token_ids), bytes(r.decoded)) for r in rows) == want


def test_language_model(awkward, small):
    for docs in (awkward, small):
        rows = rows_of(docs)
        toks = [(i, WORDS.findall(lower(t)) + [None]) for i, t in rows]
        count = Counter(w for i, ws in toks if i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for w in ws)
        n, v = sum(count.values()), len(count)
        training = docs.filter(queries.id_remainder(7) != 2)
        want = Counter((i, len(ws), sum(count[w] > 0 for w in ws), n) for i, ws in toks)
        for limit in (lm_score.BROADCAST_BYTES, 0):
            got = lm_score.score(docs, training, broadcast_bytes=limit).collect()
            assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens) for r in got) == want
            base = {i: sum(math.log10((count[w] + 1) / (n + v + 1)) for w in ws) for i, ws in toks}
            assert all(r.base_score == pytest.approx(base[r.doc_id], rel=1e-9) and r.score < 0 for r in got)
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_scores_are_the_same_at_any_size(awkward, small):
    for docs in (awkward, small):
        training = docs.filter(queries.id_remainder(7) != 2)
        whole, joined = (
            sorted(((r.doc_id or 0, r.n_tokens, r.score) for r in lm_score.score(docs, training, broadcast_bytes=b).collect()))
            for b in (lm_score.BROADCAST_BYTES, 0)
        )
        assert [r[:2] for r in whole] == [r[:2] for r in joined]
        assert [r[2] for r in whole] == pytest.approx([r[2] for r in joined], rel=1e-9)


def test_language_model_blocks_give_the_very_same_scores(spark, awkward, small):
    for docs in (awkward, small):
        rows = docs.select("doc_id", "text")
        partial = lm_score._partial_counts(docs.filter(queries.id_remainder(7) != 2).select("text"), 8)
        slices = lm_score.stored(lm_score._slices(partial), "filter").persist()
        model = lm_score._collected(slices, 8)
        listed = lambda df: sorted((str(r.doc_id), *r[1:]) for r in df.collect())
        want = listed(lm_score._by_broadcast(rows, model, lm_score.MU))
        numbered = lm_score._blocks(rows, 1 << 30)
        # One block in the hands of several tasks; a block for each text; one for all.
        pieces = numbered.withColumn("block", F.lit(7).cast("long")).repartitionByRange(3, "row").sortWithinPartitions("row")
        for keyed in (pieces, lm_score._blocks(rows, 1), numbered):
            assert listed(lm_score._by_parts(keyed, slices, 8, model.n_tokens, len(model.words), lm_score.MU)) == want


def test_language_model_shuffles_no_more_than_its_texts(spark, small):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles

    def shuffled() -> dict[str, int]:
        found = files()
        each = (found.apply(i) for i in range(found.size()))
        return {f.getName(): f.length() for f in each if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}

    before = shuffled()
    scores = lm_score.score(small, small.filter(queries.id_remainder(7) != 2), broadcast_bytes=0)
    rows = scores.collect()
    left = sum(n for name, n in shuffled().items() if name not in before)
    assert len(rows) == small.count()
    assert left < small.agg(F.sum(F.octet_length("text"))).first()[0]


def test_language_id(awkward, small, empty):
    learned = language_id.model(language_id.learn(small.filter(queries.id_remainder(3) != 1)))
    held = by_id(language_id.predict(small, learned).filter(queries.id_remainder(3) == 1))
    langs = {r.doc_id: r.lang for r in small.collect() if r.lang is not None}
    assert np.mean([r.lang_pred == langs[i] for i, r in held.items() if i in langs]) > 0.97
    got = by_id(language_id.predict(awkward, learned))
    assert all((got[i].lang_pred, got[i].score) == ("und", 0.0) for i in (4, 5, 6, 13))
    assert got[14].lang_pred == "de" and all(0 <= r.score <= 1 for r in got.values())
    none = language_id.model(language_id.learn(empty.withColumn("lang", F.lit("xx"))))
    assert {r.lang_pred for r in language_id.predict(awkward, none).collect()} == {"und"}


def test_quality(spark, awkward, empty):
    # The smallest tables hold out 19 labels only.
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, labels.filter(queries.id_remainder(5) != 0))
    truth = {r.doc_id: r.label for r in labels.collect()}
    held = by_id(quality.score(docs, model).filter(queries.id_remainder(5) == 0))
    assert np.mean([(r.score >= quality.THRESHOLD) == truth[i] for i, r in held.items() if i in truth]) > 0.9
    scores = quality.score(awkward, model).collect()
    assert len(scores) == awkward.count() and all(0 <= r.score <= 1 for r in scores)
    none = quality.fit(empty, labels.limit(0))
    assert {r.score for r in quality.score(awkward, none).collect()} == {0.5}


def test_quality_sees_wording(spark):
    """Texts of one shape, in two scripts, where the label is in the words alone."""
    rng = np.random.default_rng(5)
    good, bad = [f"{a}{b}{c}a" for a in "bdfg" for b in "aeio" for c in "lmnr"], [f"{a}{b}{c}a" for a in "hkpt" for b in "aeio" for c in "svwz"]
    hanzi = [chr(0x4E00 + i) for i in range(400)]
    rows = []
    for i in range(800):
        label = i % 2
        if i % 4 < 2:
            text = " ".join(rng.choice(good if label else bad, 40))
        else:
            text = "".join(rng.choice(hanzi[:200] if label else hanzi[200:], 60))
        rows.append((i, text, float(label)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, label double").cache()
    learned = docs.filter("doc_id < 600").select("doc_id", "label")
    model = quality.fit(docs.select("doc_id", "text"), learned)
    held = by_id(quality.score(docs.filter("doc_id >= 600").select("doc_id", "text"), model))
    assert np.mean([(held[i].score >= 0.5) == (label == 1) for i, _, label in rows[600:]]) > 0.95


def test_quality_sample_is_summed_in_tasks(spark):
    assert quality.SAMPLE >= 6000 and quality.TERMS >= 2048
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet").limit(700)
    rows = docs.select(F.col("doc_id").alias("key"), F.lit(1.0).alias("label"), "text")
    counted = quality._counted(rows, "key").cache()
    x = np.stack([np.frombuffer(r.terms, np.float32) for r in counted.collect()])
    weights = np.linspace(1, 3, x.shape[1]).astype(np.float32)
    unit = quality.unit_rows(x, weights)
    one, many = (quality._gram(counted.repartition(n), weights) for n in (1, 5))
    assert (one == many).all()  # the same sum however the rows are dealt
    assert np.allclose(one, unit.T @ unit, atol=1e-3)


class Captured:
    """Stands for a DataFrame and keeps the function given to mapInArrow."""

    schema = StructType([StructField("key", LongType())])

    def select(self, *_):
        return self

    groupBy = applyInArrow = coalesce = select

    def mapInArrow(self, run, _):
        self.run = run
        return self

    def toLocalIterator(self):
        return iter(())

    def peak(self, batch):
        """Bytes that a task takes at most for this batch."""
        import tracemalloc

        tracemalloc.start()
        try:
            rows = sum(out.num_rows for out in self.run(iter([batch])))
            return rows, tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()


def test_quality_tasks_take_little_memory():
    rng = np.random.default_rng(7)
    texts = [" ".join(map(str, rng.integers(0, 10_000, 200))) for _ in range(2100)]  # 2 MB
    batch = pa.record_batch([pa.array(range(2100)), pa.array([1.0] * 2100), pa.array(texts)], ["key", "label", "text"])
    rows, most = quality._counted(Captured(), "key").peak(batch)
    assert rows == 2100 and most < 64 << 20
    counts = rng.integers(0, 3, (300, quality.WIDE)).astype(np.float32)
    frame = Captured()
    quality._gram(frame, np.ones(quality.WIDE, np.float32))
    rows, most = frame.peak(pa.record_batch([pa.array([x.tobytes() for x in counts], pa.binary())], ["terms"]))
    assert rows == -(-quality.WIDE // quality.GRAM_ROWS) and most < 150 << 20


def test_a_vocabulary_goes_with_its_last_user():
    """A worker lets go of the broadcast of an earlier stage at once, not at the next collection of cycles."""
    import gc
    import weakref

    vocabulary = byte_bpe.Vocabulary({bytes([i]): i for i in range(256)}, r"\S+|\s+")
    codec, left = byte_bpe.Codec(vocabulary), weakref.ref(vocabulary)
    gc.disable()
    try:
        del vocabulary
        assert codec.decode(codec.encode("abc de")) == b"abc de"
        del codec
        assert left() is None
    finally:
        gc.enable()


def test_html():
    page = (
        "<html><head><title>T</title><script>var a='</p>';</script></head><body><header>Top</header><nav><ul><li><a>Home</a></ul></nav>"
        "<div class='cookie-notice'>We use</div><div id=x class='side-bar sidebar'>More</div><article><h1>Head &amp; line</h1>"
        "<p>One <b>bo</b>ld<p>two&nbsp; three<br>four<div class=comments><p>first!</div></article><!-- <p>no --><form>q</form><footer>f"
    )
    assert html_text.main_text(page) == "Head & line One bold two three four"
    assert html_text.main_text("") == html_text.main_text("<nav>only</nav>") == ""
    assert html_text.main_text("plain text") == "plain text"
    assert html_text.main_text("<p>cut <a href='x") == "cut"


def test_html_blocks_decide_without_article_and_inside_it():
    text = [" ".join(f"word{i}{j}" for j in range(40)) + "." for i in range(4)]
    paras = "".join(f"<p>{t}</p>" for t in text)
    menu = "<ul>" + "".join(f"<li><a href=/{i}>Menu entry {i}</a></li>" for i in range(6)) + "</ul>"
    table = "<table>" + "".join(f"<tr><td><a href=/{i}>Link {i}</a></td><td>{i}</td></tr>" for i in range(5)) + "</table>"
    foot = "<div>Copyright Example</div><div>Imprint</div>"
    body = f"<html><body><div>{menu}</div><div><h1>Title</h1>{paras}<p>The end.</p></div>{table}<div>{foot}</div></body></html>"
    want = " ".join(["Title", *text, "The end."])
    assert html_text.main_text(body) == want  # no article, no furniture elements or names
    inside = f"<article><h1>Title</h1>{paras}<p>The end.</p>{menu}</article><footer>f</footer>"
    assert html_text.main_text(inside) == want  # a list of links inside the article
    for names in ("id='related-work'", "class='share-price table'", "id=comment-section-of-law"):
        page = f"<article><h1>Title</h1><section {names}>{paras}</section><p>The end.</p></article>"
        assert html_text.main_text(page) == want
        assert html_text.main_text(page.replace("article", "div")) == want
    named = f"<div><h1>Title</h1>{paras}<div class='box share'>Share this now</div><p>The end.</p></div>"
    assert html_text.main_text(named) == want


def test_html_pages(spark):
    queries.ship(spark)
    rows = [(1, "u", None), (2, None, "<p>a</p>"), (2, None, "<p>a</p>")]
    got = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text, r.n_chars) for r in got) == [(1, "", 0), (2, "a", 1), (2, "a", 1)]


def test_suffix_dedup(awkward, small):
    columns = np.random.default_rng(1).integers(0, 4, (3000, 5)).astype(np.uint64)
    assert (suffix_dedup.multikey_order(columns) == np.lexsort(columns.T[::-1])).all()
    for docs in (awkward, small):
        rows = sorted({(i is None, i, t) for i, t in rows_of(docs)}, key=lambda r: (r[0], r[1] or 0))
        seen, want = set(), {}
        for _, i, t in rows:
            w = WORDS.findall(t or "")
            gone = set()
            for a in range(len(w) - 19):
                key = tuple(w[a : a + 20])
                gone.update(range(a, a + 20) if key in seen else ())
                seen.add(key)
            want[i] = (len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))
        for r in suffix_dedup.remove_repeats(docs).collect():
            assert (r.n_words, sum(s.end - s.start for s in r.removed), r.kept_text) == want[r.doc_id], r.doc_id


@pytest.mark.parametrize("shard", [8 << 20, 2000])
def test_substring_dedup(awkward, small, shard, monkeypatch):
    monkeypatch.setattr(suffix_automaton, "SHARD_BYTES", shard)
    for docs in (awkward, small):
        rows = sorted({(i is None, i, t) for i, t in rows_of(docs)}, key=lambda r: (r[0], r[1] or 0))
        seen, want = set(), {}
        for _, i, t in rows:
            b = (t or "").encode()
            gone, own = np.zeros(len(b), bool), set()
            for a in range(len(b) - 49):
                key = b[a : a + 50]
                if key in seen:
                    gone[a : a + 50] = True
                own.add(key)
            seen |= own
            runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
            want[i] = (len(b), int(gone.sum()), runs, bytes(np.frombuffer(b, np.uint8)[~gone]))
        for r in suffix_automaton.remove_spans(docs).collect():
            assert (r.n_bytes, sum(s.end - s.start for s in r.removed), len(r.removed), bytes(r.kept)) == want[r.doc_id], r.doc_id


def test_empty_tables(spark, empty, small):
    words = queries.vocabulary()
    bench = spark.createDataFrame([], "item_id long, text string")
    for result in (
        exact_dedup.exact_groups(empty), minhash.near_duplicates(empty), decontaminate.find_contamination(empty, bench),
        byte_bpe.round_trip(empty, words), lm_score.score(empty, empty), suffix_dedup.remove_repeats(empty),
        suffix_automaton.remove_spans(empty),
    ):
        assert result.collect() == []
    assert not any(r.spans for r in decontaminate.find_contamination(small, bench).collect())


def test_keyset(spark):
    rows = spark.range(2000).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit(1).alias("__x"))
    drop = spark.range(100, 300).select(F.col("id").alias("k"))
    left = [r.k for r in keyset.without(rows, "k", drop).collect()]
    assert sorted(left, key=lambda k: k or 0) == [None, *range(1, 100), *range(300, 2000)]


def test_a_search_shard_takes_little_memory():
    import tracemalloc

    words = [f"w{i % 701}" for i in range(12_000)]
    phrases = decontaminate.Phrases([("a", " ".join(words[:800]))], 10)
    texts = pa.array([" ".join(words)] * 90)  # about 5 MB, every word known
    tracemalloc.start()
    try:
        for _, _, raw, offs in tb.chunks(texts, decontaminate.SHARD_BYTES):
            starts, ends, first = tb.word_spans(raw, offs, tb.ALNUM)
            hit, _ = phrases.find(tb.word_hashes(raw, starts, ends), first)
            assert hit.all()
        assert tracemalloc.get_traced_memory()[1] < 150 << 20
    finally:
        tracemalloc.stop()
