"""Each stage of the pipeline against what its operator says of the stage's own input."""

import corpus_pipeline
from keelson.llm import queries
from tests.conftest import SMALL
from tests.llm.test_operators import brute_components, brute_hits


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").persist()
    columns = docs.columns
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stage(spark, docs, SMALL).persist()
        after = {r.doc_id: r for r in docs.collect()}
        if name == "byte_level_bpe":
            assert set(after) == set(before) and all(after[i].n_tokens > 0 for i in after if before[i].text)
            break
        assert docs.columns == columns and all(after[i] == before[i] for i in after)
        texts = {i: r.text or "" for i, r in before.items()}
        if name == "exact_dedup":
            assert set(after) == {max(i for i in texts if texts[i] == t) for t in set(texts.values())}
        if name == "minhash_near_dedup":
            assert set(after) == {c for _, c in brute_components(list(texts.items()), 5, 80).values()}
        if name == "benchmark_decontamination":
            assert set(after) == {i for i, t in texts.items() if not brute_hits(t, bench, 10)[1]}


def test_queries_are_registered():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
