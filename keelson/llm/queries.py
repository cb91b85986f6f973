"""One query for each operator of this subpackage, with production parameters, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import best_fit, byte_bpe, decontaminate, exact_dedup, html_text, language_id, lm_score, minhash, quality, suffix_automaton, suffix_dedup, turn_repair, whitening
from keelson.llm.shipping import ship

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(modulus: int, id_col: str = "doc_id") -> Column:
    """The fold of a document: crc32 of its id as text, by ``modulus``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(modulus))


def _covered(spans: str) -> Column:
    """How much a list of (start, end) covers."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = id_remainder(7) == 2
    scored = lm_score.score(docs, docs.filter(~held_out))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_automaton.remove_spans(_table(spark, sf_dir, "documents"), span=50)
    return cut.select(
        "doc_id",
        "n_bytes",
        _covered("removed").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = id_remainder(3) == 1
    learned = language_id.model(language_id.learn(docs.filter(~held_out)).persist())
    return language_id.predict(docs, learned).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), keep="max")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), window=20)
    return cut.select(
        "doc_id", "n_words", _covered("removed").alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256")
    )


def learned_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> quality.Model:
    """The quality model of the folds that may be learned."""
    labels = _table(spark, sf_dir, "labels").filter(id_remainder(5) != 0)
    return quality.fit(docs, labels.select("doc_id", F.col("quality").alias("label")))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = quality.score(docs, learned_quality(spark, docs, sf_dir))
    return scored.select(
        "doc_id",
        (id_remainder(5) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def vocabulary() -> byte_bpe.Vocabulary:
    import public_tokenizers

    return byte_bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Encode, decode the ids, and name both results."""
    return byte_bpe.round_trip(docs, vocabulary()).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(_table(spark, sf_dir, "documents"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)
    return linked.select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10
    )
    return found.select(
        "doc_id",
        "n_words",
        _covered("spans").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op11_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cut = best_fit.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), capacity=2048)
    return best_fit.pack(cut, capacity=2048).withColumn("piece", F.col("piece").cast("int"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = whitening.whiten(_table(spark, sf_dir, "embeddings"), components=8)
    return done.select(
        "vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "explained", "identity_error",
        F.posexplode("whitened").alias("at", "whitened"),
    ).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "whitened",
        F.col("explained")[F.col("at")].alias("explained"), "identity_error",
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """The turns with ``copies`` and the contract's damage, by the crc32 of ``conv_id:turn`` modulo 20; null is one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id", "turn",
        F.when(kind == 4, F.lit("user")).otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair(damaged(_table(spark, sf_dir, "conversations")), copies_col="copies")


QUERIES: dict[str, Query] = {
    "op1_lm_score": op1_lm_score,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language_id": op3_language_id,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_html_text": op5_html_text,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_quality": op7_quality,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_near_dedup": op9_near_dedup,
    "op10_decontaminate": op10_decontaminate,
    "op11_best_fit": op11_best_fit,
    "op12_whitening": op12_whitening,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY t) AS keep_id,
               count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
               sha256(t) AS text_sha256
        FROM d
    """,
}
