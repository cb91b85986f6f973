"""Category index as a table, for columns with more values than a driver or a task should hold.

The index of a value is its rank by falling count, ties by value, as
``StringIndexer`` gives it. The ranks come from a range-partitioned sort of the
grouped counts: a value's number in its partition plus the counts of the
partitions before it, so no task holds more than a partition and the driver sees a
number a partition. To apply an index, the most frequent values (``HEAVY`` at most,
none longer than ``HEAVY_LENGTH``: a broadcast of bounded size) are looked up
where the rows are; only rows of rarer values are shuffled, so a value
that holds a third of the rows moves nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.session import scratch_path

HEAVY = 10_000
HEAVY_LENGTH = 256


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with each row's place, from 0, in ``order``; the sorted table is written once to the shared folder."""
    spark = df.sparkSession
    width = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    numbered = (df.repartitionByRange(width, *order).sortWithinPartitions(*order)
                .withColumn("__at", F.monotonically_increasing_id()))  # the partition above 33 bits, the row's number below
    path = scratch_path(spark, "ranked")
    numbered.write.parquet(path)
    placed = spark.read.schema(numbered.schema).parquet(path).withColumn(
        "__part", F.call_function("shiftright", F.col("__at"), F.lit(33)).cast("int"))
    before, total = [], 0
    for r in placed.groupBy("__part").agg(F.count("*").alias("n")).orderBy("__part").collect():  # a row a partition
        before.append((r["__part"], total))
        total += r["n"]
    offsets = spark.createDataFrame(before, "__part int, __before long")
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "__part").select(*df.columns, place.alias(name))


def index_table(df: DataFrame, col: str) -> DataFrame:
    """``value, n, index`` of the column's values as text, nulls not counted."""
    counts = (df.select(F.col(col).cast("string").alias("value")).where(F.col("value").isNotNull())
              .groupBy("value").agg(F.count("*").alias("n")))
    return ranked(counts, [F.col("n").desc(), F.col("value").asc()], "index")


def apply_index(df: DataFrame, col: str, index: DataFrame, out: str | None = None, heavy: int = HEAVY) -> DataFrame:
    """``df`` with ``out`` (``<col>_index``): the index of the value as double; null and unseen values get the number of
    indexed values, a slot of their own as with ``handleInvalid="keep"``."""
    out = out or f"{col}_index"
    unseen = index.agg(F.count("*")).first()[0]
    head = index.where((F.col("index") < heavy) & (F.length("value") <= HEAVY_LENGTH))
    tail = index.where((F.col("index") >= heavy) | (F.length("value") > HEAVY_LENGTH))
    look = lambda t, name: t.select(F.col("value").alias("__value"), F.col("index").alias(name))
    keyed = df.withColumn("__key", F.col(col).cast("string"))
    near = keyed.join(F.broadcast(look(head, "__place")), F.col("__key") == F.col("__value"), "left").drop("__value")
    done = F.col("__place").isNotNull() | F.col("__key").isNull()
    if unseen <= heavy and tail.isEmpty():
        found = near
    else:
        rare = near.where(~done).drop("__place")
        rare = rare.join(look(tail, "__place"), F.col("__key") == F.col("__value"), "left").drop("__value")
        found = near.where(done).unionByName(rare)
    return found.select(*df.columns, F.coalesce("__place", F.lit(unseen)).cast("double").alias(out))
