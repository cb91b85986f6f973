"""The corpus pipeline: five operators of ``keelson.llm`` applied to ``documents`` in turn.

Each stage takes ``(spark, docs, sf_dir)``; its result is written as Parquet to
the shared folder and read back as the next one's ``docs``. All but the last
return the columns of ``docs``; the last returns the encoding of every
document that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import decontaminate, exact_dedup, keyset, minhash, quality, queries
from keelson.llm.scratch import stored
from keelson.llm.shipping import ship


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.keep_good(docs, queries.learned_quality(spark, docs, sf_dir))


def exact_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    groups = exact_dedup.exact_groups(docs, keep="max")
    return keyset.without(docs, "doc_id", stored(groups.filter("NOT kept").select("doc_id"), "copies"))


def near_dedup_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the smallest id stays."""
    ship(spark)
    linked = minhash.near_duplicates(docs, words=5, percent=80)
    return keyset.without(docs, "doc_id", stored(linked.filter("doc_id != component_id").select("doc_id"), "near"))


def decontamination_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark phrase go."""
    ship(spark)
    found = decontaminate.find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    return keyset.without(docs, "doc_id", stored(found.filter(F.size("spans") > 0).select("doc_id"), "leaks"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the byte-level BPE encoding and its decoding."""
    ship(spark)
    return queries.bpe_digests(docs)


STAGES = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", exact_dedup_filter),
    ("minhash_near_dedup", near_dedup_filter),
    ("benchmark_decontamination", decontamination_filter),
    ("byte_level_bpe", encoding),
]

#: A classifier has no SQL twin; tests/llm checks every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
