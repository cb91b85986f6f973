"""Exact deduplication by 128-bit content hash, with byte comparison inside groups.

1. Every text is named by its MD5 (128 bits) and only ``(hash, id)`` is
   aggregated: rows per hash and the stable id that stays. Copies collapse in
   the map-side combine, so a text that makes up a third of the table is one
   row per task.
2. The texts of hashes with more than one row are grouped by ``(hash, text)``,
   which compares bytes; again copies collapse before the shuffle. Texts of
   unique hashes never move: a fixed-size bitmap of the repeated hashes
   (``keyset``) is applied at the scan.
3. A hash that turns out to hold different texts (a collision) is resolved by
   ``(hash, text)`` instead of the hash. Rows are then joined to their group;
   the join moves ids and hashes only, and adaptive execution splits a hot one.

Defined results: a null text is empty; rows with a null id count in
``group_size`` and never name the group unless all its ids are null; rows that
repeat an id with the same text are one document and share its fate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import keyset


def content_hash(text: Column) -> Column:
    """The 128-bit name of a text."""
    return F.unhex(F.md5(text))


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    hash_fn: Callable[[Column], Column] = content_hash,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    ``keep`` chooses the id that stays: ``"max"`` or ``"min"``.
    """
    pick = {"max": F.max, "min": F.min}[keep]
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).select(
        "doc_id", "text", hash_fn(F.col("text")).alias("h")
    )
    named = keyed.select("doc_id", "h", F.sha2("text", 256).alias("text_sha256"))

    groups = keyed.groupBy("h").agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    repeated = keyset.build(groups.filter("group_size > 1"), "h")
    classes = (
        keyset.maybe_in(keyed, "h", repeated)
        .groupBy("h", "text")
        .agg(pick("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    collided = classes.groupBy("h").count().filter("count > 1").select("h")
    collisions = keyset.build(collided, "h")

    by_hash = named.join(groups.join(collided, "h", "left_anti"), "h")
    by_text = (
        keyset.maybe_in(keyed, "h", collisions)
        .join(classes.join(collided, "h", "left_semi"), ["h", "text"])
        .withColumn("text_sha256", F.sha2("text", 256))
    )
    columns = ("doc_id", "keep_id", "group_size", "text_sha256")
    rows = by_hash.select(*columns).unionByName(by_text.select(*columns))
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )
