"""One ordered 64-bit key for each document, whatever the ids look like.

Unique integer ids are their own keys: a scan of the ids alone finds that out.
Else (a repeated or second null id, ids of another type) the different
``(id, text)`` pairs are numbered in order: by id, null last, and by a digest
of the text where rows share an id. Numbers come from range partitions and
prefix sums of their counts, so a null id that a third of the rows have is
spread like any other. Rows that repeat id and text share a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.scratch import stored
from keelson.llm.textbytes import task

#: The key of a row whose id is null, where there is one such row only.
LAST = (1 << 63) - 1
INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def keyed(rows: DataFrame) -> DataFrame:
    """``doc_id, doc, text`` from ``doc_id, text``; ``doc`` orders the documents."""
    if isinstance(rows.schema["doc_id"].dataType, INTEGERS):
        if not rows.groupBy("doc_id").count().filter("count > 1").limit(1).count():
            return rows.select("doc_id", F.coalesce(F.col("doc_id").cast("bigint"), F.lit(LAST)).alias("doc"), "text")
    return _numbered(rows)


def _numbered(rows: DataFrame) -> DataFrame:
    named = rows.withColumn("digest", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    width = max(2, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("digest")]
    ranged = named.select("doc_id", "digest").distinct().repartitionByRange(width, *order).sortWithinPartitions(*order)
    parts = ranged.withColumn("part", F.spark_partition_id())
    schema = T.StructType([*parts.schema.fields, T.StructField("number", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.arange(seen, seen + len(batch)))], schema.names)
            seen += len(batch)

    numbers = stored(parts.mapInArrow(task(number), schema), "documents")
    counts = numbers.groupBy("part").agg(F.count("*").alias("n"))  # one row a partition
    before = {}
    for r in counts.orderBy("part").collect():
        before[r["part"]] = before.get("next", 0)
        before["next"] = before[r["part"]] + r["n"]
    offsets = rows.sparkSession.createDataFrame([(p, b) for p, b in before.items() if p != "next"], "part int, before long")
    keys = numbers.join(F.broadcast(offsets), "part").select(
        F.col("doc_id").alias("k_id"), F.col("digest").alias("k_digest"), (F.col("before") + F.col("number")).alias("doc")
    )
    met = named.join(keys, F.col("doc_id").eqNullSafe(F.col("k_id")) & (F.col("digest") == F.col("k_digest")))
    return stored(met.select("doc_id", "doc", "text"), "keyed")
