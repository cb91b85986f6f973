"""Global and per-category aggregates.

Every aggregate here is a hash aggregate with a map-side partial step, so a
category that holds a third of all rows is combined inside each task before
the (tiny) shuffle. Several statistics over several columns are computed in
one ``agg`` — one scan — instead of one job per column.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.operators.quantiles import exact_quantiles


def number(col: str | Column) -> Column:
    """A column as double, with NaN as missing."""
    x = (F.col(col) if isinstance(col, str) else col).cast("double")
    return F.when(~F.isnan(x), x)


def agg_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: the mean of each column (null when a column has no values; NaN is missing)."""
    return df.agg(*[F.avg(number(c)).alias(c) for c in cols])


def mean_values(df: DataFrame, cols: Sequence[str], default: float = 0.0) -> dict[str, float]:
    """Means as literals for imputation; an all-null column falls back to ``default``."""
    if not cols:
        return {}
    row = agg_mean(df, cols).first()
    return {c: (float(row[c]) if row[c] is not None else default) for c in cols}


def agg_median(df: DataFrame, cols: Sequence[str], exact: bool = True,
               accuracy: int = 20_000) -> DataFrame:
    """One row: the median of each column.

    ``exact`` uses the bounded two-pass order statistic (equal to SQL
    ``median``); otherwise one ``percentile_approx`` pass.
    """
    spark = df.sparkSession
    if not exact:
        return df.agg(*[F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias(c) for c in cols])
    values = median_values(df, cols, default=None, accuracy=accuracy)
    schema = ", ".join(f"`{c}` double" for c in cols)
    return spark.createDataFrame([tuple(values[c] for c in cols)], schema)


def long_form(df: DataFrame, cols: Sequence[str], key: str = "feature", value: str = "x") -> DataFrame:
    """Unpivot numeric columns into ``(feature, x)`` rows (one pass, no loop of jobs)."""
    return df.select(*[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        [], list(cols), key, value)


def median_values(df: DataFrame, cols: Sequence[str], default: float | None = 0.0,
                  accuracy: int = 20_000) -> dict[str, float | None]:
    if not cols:
        return {}
    res = exact_quantiles(long_form(df, cols), [0.5], accuracy=accuracy)
    return {c: (res[c][1][0] if c in res and res[c][0] > 0 else default) for c in cols}


def category_frequency(df: DataFrame, col: str, count_col: str = "count") -> DataFrame:
    """Rows per category (nulls included as their own group)."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))


def agg_mode(df: DataFrame, col: str) -> DataFrame:
    """Most frequent non-null value; count ties go to the smallest value.

    ``groupBy`` pre-aggregates per task; the ordering + ``limit(1)`` plans as
    a top-k (``TakeOrderedAndProject``), never a global sort.
    """
    return (df.where(F.col(col).isNotNull())
            .groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc(col))
            .limit(1))


def mode_values(df: DataFrame, cols: Sequence[str], default: str | None = None) -> dict[str, object]:
    """Modes of several columns in one aggregation: unpivot to ``(feature, v)``,
    count per pair, keep the best per feature with ``max_by`` over a
    (count, -rank) key. The per-pair counts are bounded by the categories."""
    if not cols:
        return {}
    kinds: dict[str, list[str]] = {}
    types = dict(df.dtypes)
    for c in cols:
        kinds.setdefault(types[c], []).append(c)
    found = {}
    for own in kinds.values():  # columns of one type share an unpivot, so values keep their type and order
        long = df.select(*own).unpivot([], own, "feature", "v")
        counts = long.where(F.col("v").isNotNull()).groupBy("feature", "v").agg(F.count(F.lit(1)).alias("n"))
        # Largest count wins; among equal counts the smallest value: order by (n desc, v asc).
        best = (counts.groupBy("feature")
                .agg(F.min_by("v", F.struct((-F.col("n")).alias("nn"), F.col("v").alias("vv"))).alias("v"))
                .collect())
        found.update({r["feature"]: r["v"] for r in best})
    return {c: found.get(c, default) for c in cols}


def count_rows(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def prediction_distribution(pred: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    return pred.groupBy(prediction_col).agg(F.count(F.lit(1)).alias("count"))


def positive_rate(pred: DataFrame, prediction_col: str = "prediction") -> DataFrame:
    return pred.agg(F.avg(F.col(prediction_col).cast("double")).alias("positive_rate"))


def top_1(df: DataFrame, order: Iterable[Column]) -> DataFrame:
    """First row under an explicit, tie-broken ordering (plans as a top-k)."""
    return df.orderBy(*order).limit(1)
