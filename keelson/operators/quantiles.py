"""Exact quantiles that scale.

Spark's exact ``percentile`` keeps a value → count map per group, i.e. every
distinct value of a column in one task's memory. That does not survive a
continuous column at 100 TB. Here exact order statistics are found in two
scans, neither of which holds more than a narrow slice of the data:

1. one aggregation per key: ``count``, ``min``, ``max`` and a mergeable
   KLL sketch of size ``accuracy``, read at ``p`` plus and minus twice its
   rank error for every requested probability: the two sketch values bracket
   the wanted order statistic. Sketches merge in two levels, by key and a salt
   of the task, then by key, so one feature's reducer gets ``SALTS`` sketches
   however many tasks there are.
2. one scan that classifies every value by a chain of literal comparisons
   against the merged brackets of its key (left of / inside / right of
   each bracket — whole-stage codegen, no per-row arrays) and counts
   ``(key, region, value-if-inside)`` with a map-side combine. Rows left of
   a bracket come from the region totals; a window partitioned by
   (key, bracket) walks the values inside in order and picks the one whose
   cumulative rank reaches the target.

Each bracket holds about six rank errors, near ``14·n/accuracy^0.9`` rows (fewer distinct values after
map-side combine); ties collapse into one ``(value, count)`` row, so a value
holding a third of all rows costs one row. When ``n`` is so large that a
bracket could exceed ``max_walk`` rows, refinement scans first narrow it with
an equal-width histogram of 1,024 buckets per bracket (count, min and max per
bucket; the bucket holding the rank becomes the bracket). Every round divides
a bracket's value range by up to 1,024; they go on while one narrows, so a
window partition holds ``max_walk`` rows at most, or the rows of values that
are neighbours among doubles, counted by value.
Brackets are verified (rows below ≤ rank < rows below + rows inside); a
failing target is retried with a 3x and a 30x wider bracket from the same
sketch, and only as a last resort with ``[min, max]``, which is exact
regardless of the sketch. Keys of at most ``accuracy`` values start with
``[min, max]``: their sketch brackets would be about a rank wide.

Linear interpolation between order statistics ``(n-1)·p`` matches numpy's
default and SQL ``quantile_cont``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_ACCURACY = 20_000
# Most rows one exact walk may hold in a single window partition; larger
# brackets are narrowed first by histogram refinement.
MAX_WALK = 1_000_000
REFINE_BUCKETS = 1024
MAX_REFINE_ROUNDS = 200  # a bracket of doubles cannot be narrowed more often; rounds end when none narrows
# Sketches a key's last merge gets.
SALTS = 64


def _merge(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Disjoint intervals covering the brackets (touching ones merged, so a
    value never belongs to two intervals)."""
    out: list[list[float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def _region(x, intervals: list[tuple[float, float]]):
    """Region of ``x`` among sorted disjoint intervals: 0 left of the first,
    ``2i + 1`` inside interval ``i``, ``2i + 2`` right of it. A chain of
    literal comparisons: compiled by whole-stage codegen, no per-row arrays."""
    expr = F.when(x < F.lit(intervals[0][0]), F.lit(0))
    for i, (lo, hi) in enumerate(intervals):
        if i > 0:
            expr = expr.when(x < F.lit(lo), F.lit(2 * i))
        expr = expr.when(x <= F.lit(hi), F.lit(2 * i + 1))
    return expr.otherwise(F.lit(2 * len(intervals)))


def _by_key(per_key: dict[str, F.Column]) -> F.Column:
    key, expr = F.col("_k"), None
    for k, e in per_key.items():
        expr = F.when(key == F.lit(k), e) if expr is None else expr.when(key == F.lit(k), e)
    return expr


def _sub_bucket(x, intervals: list[tuple[float, float]], buckets: int):
    """Equal-width bucket of ``x`` inside its interval (null outside any).
    ``floor((x - lo) * scale)`` is monotone in ``x``, so equal values share a
    bucket and buckets are ordered like their values."""
    expr = None
    for lo, hi in intervals:
        if hi > lo and math.isfinite(lo) and math.isfinite(hi) and math.isfinite(buckets / (hi - lo)):
            b = F.least(F.lit(buckets - 1), F.floor((x - F.lit(lo)) * F.lit(buckets / (hi - lo))).cast("int"))
        else:  # a point, or an unbounded bracket: one bucket (no NaN arithmetic under ANSI casts)
            b = F.lit(0)
        cond = (x >= F.lit(lo)) & (x <= F.lit(hi))
        expr = F.when(cond, b) if expr is None else expr.when(cond, b)
    return expr


def _refine(data: DataFrame, targets: dict[tuple[str, int], tuple[int, float, float]],
            max_walk: int = MAX_WALK, buckets: int = REFINE_BUCKETS, rounds: int = MAX_REFINE_ROUNDS):
    """Narrow brackets holding more than ``max_walk`` rows.

    Each round is one scan: every value inside a bracket gets an equal-width
    sub-bucket and ``(key, region, bucket)`` is aggregated to count, min and
    max (output bounded by keys x brackets x buckets). The bucket holding the
    target rank becomes the new bracket ``[min, max]`` — tight, because
    buckets are monotone in the value — holding exactly its count of rows. A
    bucket of one distinct value resolves the target outright.

    Returns ``(resolved, remaining)``: resolved as in ``_resolve``, the rest
    with brackets of at most ``max_walk`` rows where the data allow it.
    """
    x = F.col("_x")
    resolved: dict[tuple[str, int], tuple[float, int, int]] = {}
    cur = dict(targets)
    for _ in range(rounds):
        intervals: dict[str, list[tuple[float, float]]] = {}
        for (k, _t), (_r, lo, hi) in cur.items():
            intervals.setdefault(k, []).append((lo, hi))
        intervals = {k: _merge(v) for k, v in intervals.items()}
        region = _by_key({k: _region(x, ivs) for k, ivs in intervals.items()})
        sub = _by_key({k: _sub_bucket(x, ivs, buckets) for k, ivs in intervals.items()})
        hist = (data.where(F.col("_k").isin(list(intervals)))
                .select("_k", region.alias("region"), F.when(region % 2 == 1, sub).alias("sub"), "_x")
                .groupBy("_k", "region", "sub")
                .agg(F.count(F.lit(1)).alias("c"), F.min("_x").alias("mn"), F.max("_x").alias("mx"))
                .collect())
        totals: dict[tuple[str, int], int] = {}
        cells: dict[tuple[str, int], dict[int, tuple[int, float, float]]] = {}
        for r in hist:
            totals[(r["_k"], r["region"])] = totals.get((r["_k"], r["region"]), 0) + r["c"]
            if r["sub"] is not None:
                cells.setdefault((r["_k"], r["region"]), {})[r["sub"]] = (r["c"], r["mn"], r["mx"])
        nxt, progressed = {}, False
        for (k, tid), (rank, lo, hi) in cur.items():
            i = next(j for j, (a, b) in enumerate(intervals[k]) if a <= lo and hi <= b)
            reg = 2 * i + 1
            below = sum(c for (kk, g), c in totals.items() if kk == k and g < reg)
            inside = totals.get((k, reg), 0)
            if inside <= max_walk or not (below <= rank < below + inside):
                nxt[(k, tid)] = (rank, lo, hi)  # small enough, or left for verification to reject
                continue
            acc = below
            for j in sorted(cells.get((k, reg), {})):
                c, mn, mx = cells[(k, reg)][j]
                if acc + c > rank:
                    if mn == mx:
                        resolved[(k, tid)] = (mn, acc, acc + c)
                    else:
                        nxt[(k, tid)] = (rank, mn, mx)
                        # Fewer rows, or the same rows in a narrower value range
                        # (then the next round's buckets split them).
                        progressed = progressed or c < inside or mn > lo or mx < hi
                    break
                acc += c
        cur = nxt
        if not progressed:
            break
    return resolved, cur


def _resolve(data: DataFrame, targets: dict[tuple[str, int], tuple[int, float, float]]
             ) -> dict[tuple[str, int], tuple[float, int, int]]:
    """Exact order statistics for ``targets`` = {(key, tid): (rank, lo, hi)}.

    Returns {(key, tid): (value, #values < value, #values <= value)} for
    every target whose bracket verified.
    """
    spark = data.sparkSession
    intervals: dict[str, list[tuple[float, float]]] = {}
    for (k, _), (_, lo, hi) in targets.items():
        intervals.setdefault(k, []).append((lo, hi))
    intervals = {k: _merge(v) for k, v in intervals.items()}

    x, key = F.col("_x"), F.col("_k")
    region = _by_key({k: _region(x, ivs) for k, ivs in intervals.items()})
    inside = (region % 2) == 1
    counted = (data.where(key.isin(list(intervals)))
               .select("_k", region.alias("region"), F.when(inside, x).alias("v"))
               .groupBy("_k", "region", "v").agg(F.count(F.lit(1)).alias("c"))
               .persist(StorageLevel.MEMORY_AND_DISK))  # read by both aggregates below, the data once

    # Rows left of each region (tiny: keys x regions rows).
    totals = counted.groupBy("_k", "region").agg(F.sum("c").alias("tot"))
    left = Window.partitionBy("_k").orderBy("region").rowsBetween(Window.unboundedPreceding, -1)
    below = totals.withColumn("below", F.coalesce(F.sum("tot").over(left), F.lit(0)))

    rows = []
    for (k, tid), (rank, lo, hi) in targets.items():
        i = next(j for j, (a, b) in enumerate(intervals[k]) if a <= lo and hi <= b)
        rows.append((k, tid, rank, 2 * i + 1))
    wanted = spark.createDataFrame(rows, "_k string, tid int, rank long, region int")

    # Within one interval (bounded by the bracket width) walk values in order.
    upto = Window.partitionBy("_k", "region").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    picked = (counted.where(F.col("region") % 2 == 1)
              .withColumn("cum", F.sum("c").over(upto))
              .join(below, ["_k", "region"])
              .join(F.broadcast(wanted), ["_k", "region"])
              .where(F.col("below") + F.col("cum") > F.col("rank"))
              .groupBy("_k", "tid")
              .agg(F.min_by(F.struct("v", "cum", "c"), "v").alias("m"),
                   F.max("below").alias("below"), F.max("rank").alias("rank")))
    try:
        walked = picked.collect()
    finally:
        counted.unpersist()
    out = {}
    for r in walked:
        if r["below"] <= r["rank"]:
            le = r["below"] + r["m"]["cum"]
            out[(r["_k"], r["tid"])] = (r["m"]["v"], le - r["m"]["c"], le)
    return out


@dataclass(frozen=True)
class QuantileSummary:
    """Per key: ``n`` values (null/NaN excluded), ``n_all`` rows, the
    quantiles and, for each, how many values are strictly below it."""
    n: int
    n_all: int
    values: list[float | None]
    count_below: list[int | None]


def _size(accuracy: int) -> int:
    return min(65_535, max(8, accuracy))


def _rank_error(accuracy: int) -> float:
    """Share of the ranks by which a KLL sketch of this size is off, with 99 % confidence (from its published fit)."""
    return min(1.0, 2.296 / _size(accuracy) ** 0.9021)


def _deltas(accuracy: int) -> list[float]:
    # Bracket levels, narrowest first: 2, 6 and 60 rank errors (then [min, max]).
    return [k * _rank_error(accuracy) for k in (2.0, 6.0, 60.0)]


def sketch_probabilities(probs: Sequence[float], accuracy: int = DEFAULT_ACCURACY) -> list[float]:
    """The ranks at which pass 1 reads the sketch for ``probs``."""
    return sorted({min(1.0, max(0.0, float(p) + s * d)) for p in probs for d in _deltas(accuracy)
                   for s in (-1.0, 1.0)})


def sketched(raw: DataFrame, probs: Sequence[float], accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """Pass 1 over ``_k, _x``: ``_k, n, n_all, mn, mx, approx`` (null and NaN are not values).

    Two exchanges: by key and salt, where the tasks' sketches meet, and by key.
    """
    size = F.lit(_size(accuracy))
    value = F.when(F.col("_x").isNotNull() & ~F.isnan("_x"), F.col("_x"))
    salted = raw.select("_k", value.alias("v"), F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
    parts = salted.groupBy("_k", "salt").agg(
        F.count("v").alias("n"), F.count(F.lit(1)).alias("n_all"), F.min("v").alias("mn"), F.max("v").alias("mx"),
        F.kll_sketch_agg_double("v", size).alias("sketch"))
    merged = parts.groupBy("_k").agg(
        F.sum("n").alias("n"), F.sum("n_all").alias("n_all"), F.min("mn").alias("mn"), F.max("mx").alias("mx"),
        F.kll_merge_agg_double("sketch", size).alias("sketch"))
    ranks = F.lit(sketch_probabilities(probs, accuracy))
    return merged.select("_k", "n", "n_all", "mn", "mx",
                         F.when(F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", ranks)).alias("approx"))


def quantile_summary(long_df: DataFrame, probs: Sequence[float], key: str = "feature",
                     value: str = "x", accuracy: int = DEFAULT_ACCURACY,
                     max_walk: int = MAX_WALK) -> dict[str, QuantileSummary]:
    """Exact linear-interpolated quantiles of ``value`` per ``key`` with
    the number of values below each one (enough to count any bin between
    quantiles without another scan). A bounded summary: keys x probs.

    ``sketches`` ({key: row with n, n_all, mn, mx, approx} from
    ``sketch_columns``) skips pass 1 when the caller already aggregated it.
    """
    probs = [float(p) for p in probs]
    if any(p < 0 or p > 1 for p in probs):
        raise ValueError("probabilities must be in [0, 1]")
    raw = long_df.select(F.col(key).cast("string").alias("_k"), F.col(value).cast("double").alias("_x"))
    valid = F.col("_x").isNotNull() & ~F.isnan("_x")
    deltas = _deltas(accuracy)
    side = sketch_probabilities(probs, accuracy)
    stats = [r.asDict() for r in sketched(raw, probs, accuracy).collect()]

    levels: list[dict[tuple[str, int], tuple[int, float, float]]] = [{} for _ in range(len(deltas) + 1)]
    level_widths = [2 * (d + _rank_error(accuracy)) for d in deltas] + [1.0]
    n_of = {r["_k"]: r["n"] for r in stats}
    layout: dict[str, tuple[int, int, list[tuple[int, int, float]]]] = {}
    for r in stats:
        k, n, mn, mx = r["_k"], r["n"], r["mn"], r["mx"]
        layout[k] = (n, r["n_all"], [])
        if n == 0:
            continue
        approx = dict(zip(side, r["approx"]))
        rank_tid: dict[int, int] = {}
        for p in probs:
            h = (n - 1) * p
            r0 = int(math.floor(h))
            r1 = min(r0 + 1, n - 1)
            brackets = []
            for d in deltas:
                a, b = approx[max(0.0, p - d)], approx[min(1.0, p + d)]
                brackets.append((mn if p - d <= 0 else min(a, b), mx if p + d >= 1 else max(a, b)))
            brackets.append((mn, mx))
            if n <= _size(accuracy):  # a sketch bracket would be under a few ranks wide and miss a neighbour
                brackets = [(mn, mx)] * len(brackets)
            for rank in (r0, r1):
                if rank not in rank_tid:
                    rank_tid[rank] = len(rank_tid)
                tid = rank_tid[rank]
                for level, (lo, hi) in zip(levels, brackets):
                    old = level.get((k, tid))
                    if old is not None:
                        lo, hi = min(lo, old[1]), max(hi, old[2])
                    level[(k, tid)] = (rank, lo, hi)
            layout[k][2].append((rank_tid[r0], rank_tid[r1], h - r0))

    data = raw.where(valid)
    found: dict[tuple[str, int], tuple[float, int, int]] = {}
    for width, level in zip(level_widths, levels):
        pending = {t: b for t, b in level.items() if t not in found}
        if not pending:
            break
        # Expected rows per bracket from the sketch's probability width; only
        # when that may exceed ``max_walk`` is a refinement scan spent.
        if any(width * n_of[k] > max_walk for (k, _) in pending):
            direct, pending = _refine(data, pending, max_walk)
            found.update(direct)
        if pending:
            found.update(_resolve(data, pending))

    out: dict[str, QuantileSummary] = {}
    for k, (n, n_all, per_prob) in layout.items():
        if n == 0:
            out[k] = QuantileSummary(0, n_all, [None] * len(probs), [None] * len(probs))
            continue
        qs, below = [], []
        for t0, t1, frac in per_prob:
            (a, a_lt, a_le), (b, b_lt, _) = found[(k, t0)], found[(k, t1)]
            q = a if frac == 0 or a == b else a + (b - a) * frac
            qs.append(q)
            # a and b are adjacent order statistics: nothing lies strictly between them.
            below.append(a_lt if q == a else b_lt if q == b else a_le)
        out[k] = QuantileSummary(n, n_all, qs, below)
    return out


def exact_quantiles(long_df: DataFrame, probs: Sequence[float], key: str = "feature",
                    value: str = "x", accuracy: int = DEFAULT_ACCURACY, max_walk: int = MAX_WALK
                    ) -> dict[str, tuple[int, list[float | None]]]:
    """Exact linear-interpolated quantiles of ``value`` per ``key``.

    Nulls and NaN are ignored. Returns {key: (n, [q(p) for p in probs])};
    a key without values has n = 0 and null quantiles. The result is a
    bounded summary (keys x probabilities) and is returned to the caller,
    like the surrogate values of a fitted imputer.
    """
    summary = quantile_summary(long_df, probs, key, value, accuracy, max_walk)
    return {k: (s.n, s.values) for k, s in summary.items()}
