"""Modelling tables derived from the input tables.

``model_rows`` is ``orders`` with the columns a model of an order would use:
its price, month and age, its priority and its status. Nulls and the label
are made by formula from the key, so Spark and the SQL oracle produce
identical rows. The SQL twins live in ``keelson.plans.sql``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import hash_unit
from keelson.sources import read_table

# Fixed values of the fixture (see FIXTURES.md): null rates, label seed.
LABEL_SEED = 7
SPLIT_SEED = 42
FOLD_SEED = 43
PRICE_NULL_EVERY = 311
AGE_NULL_EVERY = 7
STATUS_NULL_EVERY = 89
AGE_AS_OF = "2002-01-01"

ID = "id"
NUMERIC = ["price", "month", "age_days"]
CATEGORICAL = ["priority", "status"]
INDEXED = [f"{c}_index" for c in CATEGORICAL]
# Slot order of the feature vector is part of the contract.
FEATURES = NUMERIC + INDEXED

RAW_CONTRACT = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("price", T.DoubleType(), True),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("age_days", T.DoubleType(), True),
    T.StructField("priority", T.StringType(), False),
    T.StructField("status", T.StringType(), True),
])


def model_rows(spark: SparkSession, sf_dir: str, with_label: bool = True) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    price, month = F.col("o_totalprice") / F.lit(1000.0), F.month(date)
    age = F.datediff(F.lit(AGE_AS_OF).cast("date"), date)
    present = lambda every: F.pmod(key, F.lit(every)) != 0
    cols = [
        key.alias("id"),
        F.when(present(PRICE_NULL_EVERY), price).alias("price"),
        month.alias("month"),
        F.when(present(AGE_NULL_EVERY), age.cast("double")).alias("age_days"),
        F.col("o_orderpriority").alias("priority"),
        F.when(present(STATUS_NULL_EVERY), F.col("o_orderstatus")).alias("status"),
    ]
    if with_label:
        u = hash_unit(key, LABEL_SEED)
        score = (F.lit(1.8) * (F.col("o_orderpriority") == "1-URGENT").cast("double")
                 + F.lit(0.006) * price
                 - F.lit(0.3) * month.cast("double")
                 + F.lit(2.0) * (u - F.lit(0.5)))
        cols.append((score > 0).cast("double").alias("label"))
    return o.select(*cols)


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with ``value`` as text, every 13th key's value replaced by
    ``'bad'`` and every 17th ``event_type`` nulled — input for contract checks."""
    e = read_table(spark, sf_dir, "events")
    k = F.col("event_id")
    return e.select(
        k,
        F.when(F.pmod(k, F.lit(17)) != 0, F.col("event_type")).alias("event_type"),
        F.when(F.pmod(k, F.lit(13)) == 0, F.lit("bad")).otherwise(F.col("value").cast("string")).alias("value"),
        F.col("user_id").cast("string").alias("user_id"),
    )


def request_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``model_rows`` as incoming request records (every field as text, no
    label) with defects made by formula: every 11th id sends a non-numeric
    ``month``, every 19th omits the required ``priority``."""
    raw = model_rows(spark, sf_dir, with_label=False)
    k = F.col("id")
    texts = {c: F.col(c).cast("string") for c in raw.columns}
    texts["month"] = F.when(F.pmod(k, F.lit(11)) == 0, F.lit("May")).otherwise(texts["month"])
    texts["priority"] = F.when(F.pmod(k, F.lit(19)) != 0, texts["priority"])
    return raw.select(*[e.alias(c) for c, e in texts.items()])


EVENTS_CONTRACT = T.StructType([
    T.StructField("event_id", T.LongType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
    T.StructField("user_id", T.LongType(), False),
])


# (pair name, table, baseline predicate, current predicate, column): drift
# pairs with known behaviour — a seasonal split, a shifted range, two event
# types, two return flags over tied values, and a constant baseline.
DRIFT_PAIRS = [
    ("orders_half_year", "orders", "month(o_orderdate) <= 6", "month(o_orderdate) > 6", "o_totalprice"),
    ("lineitem_quantity_shift", "lineitem", "l_quantity < 30", "l_quantity >= 15", "l_quantity"),
    ("events_click_view", "events", "event_type = 'click'", "event_type = 'view'", "value"),
    ("lineitem_discount_flag", "lineitem", "l_returnflag = 'A'", "l_returnflag = 'N'", "l_discount"),
    ("lineitem_constant", "lineitem", "l_quantity = 7", "l_quantity = 8", "l_quantity"),
]


def drift_long_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Baseline and current sides of every pair as ``(feature, x)`` rows with
    ONE scan per table and side: each row emits one ``(pair, value)`` entry
    per pair whose predicate it satisfies (``stack``), the rest are dropped.
    Several pairs over the same large table never rescan it."""
    sides = []
    for which in (2, 3):
        parts = None
        for table in dict.fromkeys(p[1] for p in DRIFT_PAIRS):
            pairs = [p for p in DRIFT_PAIRS if p[1] == table]
            t = read_table(spark, sf_dir, table)
            args, any_pair = [], None
            for p in pairs:
                cond = F.expr(p[which])
                args += [F.when(cond, F.lit(p[0])), F.col(p[4]).cast("double")]
                any_pair = cond if any_pair is None else any_pair | cond
            # The OR of the pair predicates is pushed into the Parquet scan
            # (row-group skipping); the stack then routes rows to their pairs.
            long = (t.where(any_pair)
                    .select(F.stack(F.lit(len(pairs)), *args).alias("feature", "x"))
                    .where(F.col("feature").isNotNull()))
            parts = long if parts is None else parts.unionByName(long)
        sides.append(parts)
    return sides[0], sides[1]
