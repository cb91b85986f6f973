"""Splitting, fold assignment and sampling.

The default split is keyed: a row's side depends only on ``md5(seed:key)``,
never on partitioning or on which task re-ran after an executor loss, and
the filter is a plain deterministic predicate that Catalyst can push and
reorder.

Permutations and splits of exact size need each row's place in a keyed order:
``positions`` sorts by range and adds the counts of the partitions before, so
no task sees more than a partition and the result is the same at any layout.
The forms without a key draw by ``rand``; their draws depend on the partition
layout of the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.functions import hash_bucket, hash_unit
from keelson.session import scratch_path


def split_column(key: str | Column, test_size: float, seed: int, name: str = "split",
                 method: str = "md5") -> Column:
    return (F.when(hash_unit(key, seed, method) < F.lit(float(test_size)), F.lit("test"))
            .otherwise(F.lit("train")).alias(name))


def split_hash(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42, method: str = "md5"
               ) -> tuple[DataFrame, DataFrame]:
    """(train, test): test holds rows whose uniform hash draw is < ``test_size``."""
    u = hash_unit(key, seed, method)
    return df.where(u >= F.lit(float(test_size))), df.where(u < F.lit(float(test_size)))


def filter_split(df: DataFrame, draw_col: str, threshold: float, side: str) -> DataFrame:
    """Keep one side of a split on a draw column and drop the helper column.
    A row without a draw belongs to the training side."""
    test = F.coalesce(F.col(draw_col) < F.lit(float(threshold)), F.lit(False))
    cond = test if side == "test" else ~test
    return df.where(cond).drop(draw_col)


def split_rand(df: DataFrame, test_size: float = 0.2, seed: int = 42,
               stabilize: bool = False) -> tuple[DataFrame, DataFrame]:
    """(train, test) from a seeded ``rand`` column.

    ``rand(seed)`` is a function of the partition index and the row position
    within the partition, so both filters of the same deterministic plan
    (a file scan) see the same draws — also when a lost task is recomputed —
    and every row lands on exactly one side without caching the input.
    ``stabilize`` sorts within partitions first, for inputs whose row order
    is not deterministic (e.g. after a shuffle), as ``randomSplit`` does.
    """
    if stabilize:
        df = df.sortWithinPartitions(*[c for c, t in df.dtypes if not t.startswith(("array", "map", "struct"))])
    drawn = df.withColumn("_draw", F.rand(seed))
    return (filter_split(drawn, "_draw", test_size, "train"),
            filter_split(drawn, "_draw", test_size, "test"))


def rand_split_column(df: DataFrame, test_size: float = 0.2, seed: int = 42, name: str = "split") -> DataFrame:
    """``split_rand`` as one column (``test`` / ``train``) instead of two
    frames: the same draws, one pass over the input."""
    draw = F.rand(seed)
    return df.withColumn(name, F.when(draw < F.lit(float(test_size)), F.lit("test")).otherwise(F.lit("train")))


def positions(df: DataFrame, key: str, seed: int = 1, by: tuple[str, ...] = (), name: str = "position") -> DataFrame:
    """``df`` with each row's place, from 0, in the order of a seeded hash of its key (then the key).

    With ``by``, places count from 0 in every group of those columns. Keys
    should be unique: rows that share one are next to each other in any order.
    The sorted table is written once to the shared folder; a row's number in
    its partition and the counts of the partitions before it give its place.
    """
    spark = df.sparkSession
    width = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [*map(F.col, by), F.col("__draw"), F.col(key)]
    ranged = (df.withColumn("__draw", hash_unit(key, seed)).repartitionByRange(width, *order)
              .sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()).drop("__draw"))
    path = scratch_path(spark, "positions")
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path)
    part = F.call_function("shiftright", F.col("__at"), F.lit(33)).cast("int")  # the id's upper bits; the rest counts rows
    number = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    held = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).orderBy("__part").collect()  # a row a partition
    before, total = [], 0
    for r in held:
        before.append((r["__part"], total))
        total += r["n"]
    offsets = spark.createDataFrame(before, "__part int, __before long")
    out = placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    out = out.withColumn("__place", F.col("__before") + number)
    if not by:
        return out.select(*df.columns, F.col("__place").alias(name))
    first = out.groupBy(*by).agg(F.min("__place").alias("__first"))  # a row a group
    joined = out.join(first.withColumnsRenamed({c: f"__by_{c}" for c in by}),
                      [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by])
    return joined.select(*df.columns, (F.col("__place") - F.col("__first")).alias(name))


def exact_split_column(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42,
                       by: tuple[str, ...] = (), name: str = "split") -> DataFrame:
    """``df`` with a split column: ``round(n * test_size)`` rows are ``test``, in each group of ``by`` if given."""
    placed = positions(df, key, seed, by, "__position")
    sizes = placed.groupBy(*by).agg(F.round(F.count("*") * F.lit(float(test_size))).cast("long").alias("__tests"))
    if by:
        sizes = sizes.withColumnsRenamed({c: f"__by_{c}" for c in by})
        joined = placed.join(sizes, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by])
        tests = F.col("__tests")
    else:
        joined, tests = placed, F.lit(sizes.first()[0])
    return joined.select(*df.columns, F.when(F.col("__position") < tests, "test").otherwise("train").alias(name))


def split_random(df: DataFrame, test_size: float = 0.2, seed: int = 42, key: str | None = None,
                 by: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(train, test): with a key a split of exact size (in each group of ``by``), the same at any layout;
    without one Spark's ``randomSplit([1 - t, t], seed)``."""
    if key is None:
        train, test = df.randomSplit([1.0 - test_size, test_size], seed=seed)
        return train, test
    split = exact_split_column(df, key, test_size, seed, by, "__split")
    return tuple(split.where(F.col("__split") == side).drop("__split") for side in ("train", "test"))


def kfold_assign(df: DataFrame, key: str, k: int = 3, seed: int = 43, fold_col: str = "fold",
                 method: str = "md5") -> DataFrame:
    """Add an integer fold id in ``[0, k)`` from the keyed hash (usable as
    ``CrossValidator(foldCol=...)``)."""
    return df.withColumn(fold_col, hash_bucket(key, seed, k, method))


def limit_sample(df: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """``n`` rows chosen by a seeded hash order of the key.

    Plans as a top-k (each task keeps its ``n`` best, then one merge), so the
    cost is one scan and the shuffle is ``tasks x n`` rows, independent of the
    table size. The limit is the feature here: this is a sampling operator.
    """
    return df.orderBy(hash_unit(key, seed), F.col(key)).limit(n)


def shuffle_rows(df: DataFrame, seed: int = 1, key: str | None = None) -> DataFrame:
    """A seeded permutation of the rows: with a key as ``position`` (the same at any layout), else by a global sort on ``rand``."""
    return df.orderBy(F.rand(seed)) if key is None else positions(df, key, seed)
