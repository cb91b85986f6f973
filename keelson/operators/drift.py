"""Distribution drift (population stability index) between two DataFrames.

Both inputs are unpivoted to ``(feature, x)`` so all features are handled by
one plan — one pass per side, no loop of jobs per column:

1. bin edges: exact quantiles of the **baseline** at ``0, 1/bins, …, 1``
   (de-duplicated, sorted), from the bounded two-pass order statistic;
2. every value is binned against its feature's edges (right-open bins, last
   edge included, values outside the range clipped into the end bins). The
   edges are a bounded summary (features × (bins + 1) numbers), so they are
   inlined as literal comparisons — codegen'd, no join, no per-row arrays;
3. the baseline's bin counts come out of the quantile summary (it knows
   how many values lie below every edge), so the baseline is scanned twice
   in all; the current side is binned and counted with
   ``groupBy(feature, bin).count()`` (map-side combined, so a value holding
   a third of the rows costs nothing extra);
4. shares floored at 1e-6, PSI = Σ (a − e) · ln(a / e) over the baseline's
   bins; a constant baseline has a single edge, no bins, PSI 0.

Nulls/NaN are excluded from the edges and the shares and reported as
``null_share_*`` next to the PSI, so missing values cannot hide drift.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import bin_of
from keelson.operators.aggregate import long_form
from keelson.operators.quantiles import DEFAULT_ACCURACY, exact_quantiles, quantile_summary

# PSI share floor, default bin count and drift threshold.
SHARE_FLOOR = 1e-6
#: Bin of a value whose feature has no edges (an empty or missing baseline).
NO_BIN = -1
DEFAULT_BINS = 10
DEFAULT_THRESHOLD = 0.2


def quantile_grid(bins: int = DEFAULT_BINS) -> list[float]:
    """Probabilities ``0, 1/bins, …, 1`` computed as ``i * (1/bins)`` with the
    last point exactly 1 — the same doubles as an evenly spaced grid from
    numpy (``7 * 0.1`` is ``0.7000000000000001``, not ``0.7``). Edges sit
    between tied values, so the grid decides bins up to the last bit."""
    step = 1.0 / bins
    return [i * step for i in range(bins)] + [1.0]


def vector_slot(df: DataFrame, vector_col: str, i: int, name: str | None = None) -> DataFrame:
    return df.select(vector_to_array(F.col(vector_col))[i].alias(name or f"{vector_col}_{i}"))


def vector_long(df: DataFrame, vector_col: str, names: Sequence[str]) -> DataFrame:
    """All slots of a vector as ``(feature, x)`` rows via ``posexplode``."""
    names_arr = F.array(*[F.lit(n) for n in names])
    return (df.select(F.posexplode(vector_to_array(F.col(vector_col))).alias("pos", "x"))
            .select(names_arr[F.col("pos")].alias("feature"), "x"))


def _valid(x) -> F.Column:
    return x.isNotNull() & ~F.isnan(x)


def edge_lists(base_long: DataFrame, bins: int = DEFAULT_BINS,
               accuracy: int = DEFAULT_ACCURACY) -> dict[str, list[float]]:
    """{feature: sorted distinct quantile edges of the baseline} — a bounded
    summary (features x (bins + 1) numbers)."""
    q = exact_quantiles(base_long, quantile_grid(bins), accuracy=accuracy)
    return {f: sorted(set(v for v in qs if v is not None)) for f, (n, qs) in q.items() if n > 0}


def quantile_edges(base_long: DataFrame, bins: int = DEFAULT_BINS,
                   accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """``(feature, edges)``: the baseline's de-duplicated quantile edges."""
    edges = edge_lists(base_long, bins, accuracy)
    return base_long.sparkSession.createDataFrame(list(edges.items()), EDGE_SCHEMA)


def _bin_column(edges: dict[str, list[float]]) -> F.Column:
    x, feature = F.col("x"), F.col("feature")
    expr = None
    for f, e in edges.items():
        b = bin_of(x, e)
        expr = F.when(feature == F.lit(f), b) if expr is None else expr.when(feature == F.lit(f), b)
    unknown = F.lit(NO_BIN)
    return F.when(_valid(x), unknown if expr is None else expr.otherwise(unknown))


def bucketize(long_df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """Attach the bin of every value (null for null/NaN, ``NO_BIN`` for a value
    of a feature without edges). The edges are literals in the plan, so
    binning is codegen'd."""
    return long_df.select("feature", "x", _bin_column(edges).alias("bin"))


def bin_counts(long_df: DataFrame, edges: dict[str, list[float]], name: str) -> DataFrame:
    return bucketize(long_df, edges).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias(name))


def _all_bins(spark, edges: dict[str, list[float]]) -> DataFrame:
    rows = [(f, b) for f, e in edges.items() for b in range(len(e) - 1)]
    return spark.createDataFrame(rows, "feature string, bin int")


def bin_shares(long_df: DataFrame, edges: dict[str, list[float]]) -> DataFrame:
    """``(feature, bin, share)`` for every bin of the edges, floored at 1e-6."""
    with_bins = [f for f, e in edges.items() if len(e) > 1]
    counts = bin_counts(long_df, edges, "c").where(F.col("bin").isNotNull() & F.col("feature").isin(with_bins))
    # Every bin listed with count 0, plus the counted bins: union + grouped sum, no join.
    zero = _all_bins(long_df.sparkSession, edges).select("feature", "bin", F.lit(0).cast("long").alias("c"))
    per_bin = zero.unionByName(counts).groupBy("feature", "bin").agg(F.sum("c").alias("c"))
    # The window runs over (features x bins) rows, after the aggregation.
    total = F.sum("c").over(Window.partitionBy("feature"))
    return per_bin.select("feature", "bin", _share(F.col("c"), total).alias("share"))


def _share(c, total) -> F.Column:
    raw = F.when(total > 0, F.coalesce(c, F.lit(0)).cast("double") / total.cast("double")).otherwise(F.lit(0.0))
    return F.greatest(raw, F.lit(SHARE_FLOOR))


def _summary_edges(summary) -> dict[str, list[float]]:
    return {f: sorted(set(s.values)) for f, s in summary.items() if s.n > 0}


def _baseline_bins(summary, edges: dict[str, list[float]]) -> list[tuple[str, int, int]]:
    """Baseline count per bin from the quantile summary alone: bin j holds
    ``#(x < e_j+1) - #(x < e_j)``, the last bin everything from its lower edge
    up — the summary already knows how many values lie below every edge."""
    rows = []
    for f, e in edges.items():
        s = summary[f]
        below = dict(zip(s.values, s.count_below))
        m = len(e) - 1
        for j in range(m):
            upper = below[e[j + 1]] if j < m - 1 else s.n
            rows.append((f, j, upper - below[e[j]]))
    return rows


def psi_long(base_long: DataFrame, cur_long: DataFrame, bins: int = DEFAULT_BINS,
             accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """``(feature, psi, one_sided, null_share_baseline, null_share_current)``
    per feature; ``one_sided`` means that only one side has any value, where
    PSI has no bins to compare.

    The baseline is scanned twice (sketch, exact brackets): its bin counts
    and totals come out of the quantile summary as a handful of rows. The
    current side is scanned once, binned against the literal edges and
    counted. After that one chain — union, grouped sum, per-feature window,
    grouped sum — over features x bins rows: no joins, and the current
    side's aggregate has a single consumer, so it is computed once.
    """
    spark = base_long.sparkSession
    summary = quantile_summary(base_long, quantile_grid(bins), accuracy=accuracy)
    edges = _summary_edges(summary)
    with_bins = [f for f, e in edges.items() if len(e) > 1]  # a constant baseline has no bins

    # Baseline: one row per bin (zero counts included) and one totals row per feature.
    base_rows = [(f, j, n, None, None) for f, j, n in _baseline_bins(summary, edges)]
    base_rows += [(f, None, None, s.n, s.n_all) for f, s in summary.items()]
    base = spark.createDataFrame(base_rows, "feature string, bin int, e_n long, e_tot long, e_all long")
    nul = F.lit(None).cast("long")
    cur = bin_counts(cur_long, edges, "a_n").select("feature", "bin", nul.alias("e_n"), nul.alias("e_tot"),
                                                    nul.alias("e_all"), "a_n")
    per_bin = (base.withColumn("a_n", nul).unionByName(cur)
               .groupBy("feature", "bin")
               .agg(*[F.sum(c).alias(c) for c in ("e_n", "e_tot", "e_all", "a_n")]))

    w = Window.partitionBy("feature")  # over features x bins rows
    has_bin = F.col("bin").isNotNull()
    valid = has_bin & F.col("feature").isin(with_bins)
    tot = per_bin.select(
        "feature", valid.alias("valid"), "e_n", "a_n",
        F.sum("e_tot").over(w).alias("e_tot"), F.sum("e_all").over(w).alias("e_all"),
        F.sum(F.when(has_bin, F.col("a_n"))).over(w).alias("a_tot"), F.sum("a_n").over(w).alias("a_all"))
    e = _share(F.col("e_n"), F.coalesce("e_tot", F.lit(0)))
    a = _share(F.col("a_n"), F.coalesce("a_tot", F.lit(0)))
    term = F.when(F.col("valid"), (a - e) * F.log(a / e))
    rep = tot.groupBy("feature").agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("psi"),
                                     *[F.max(c).alias(c) for c in ("e_tot", "e_all", "a_tot", "a_all")])
    null_share = lambda tot_, all_: F.when(all_ > 0, (all_ - F.coalesce(tot_, F.lit(0))).cast("double") / all_)
    has = lambda tot_: F.coalesce(tot_, F.lit(0)) > 0
    return rep.select("feature", "psi", (has(F.col("e_tot")) != has(F.col("a_tot"))).alias("one_sided"),
                      null_share(F.col("e_tot"), F.col("e_all")).alias("null_share_baseline"),
                      null_share(F.col("a_tot"), F.col("a_all")).alias("null_share_current"))


def drift_report_long(base_long: DataFrame, cur_long: DataFrame, threshold: float = DEFAULT_THRESHOLD,
                      bins: int = DEFAULT_BINS, method: str = "psi",
                      accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """One row per feature: ``feature, method, psi, threshold, drift`` (strict
    ``psi > threshold``, or values on one side only) and the null shares of
    both sides."""
    if method != "psi":
        raise ValueError(f"unknown drift method {method!r}")
    rep = psi_long(base_long, cur_long, bins, accuracy)
    return rep.select("feature", F.lit(method).alias("method"), "psi",
                      F.lit(float(threshold)).alias("threshold"),
                      ((F.col("psi") > F.lit(float(threshold))) | F.col("one_sided")).alias("drift"),
                      "null_share_baseline", "null_share_current")


def drift_report(baseline: DataFrame, current: DataFrame, cols: Sequence[str],
                 threshold: float = DEFAULT_THRESHOLD, bins: int = DEFAULT_BINS,
                 method: str = "psi", accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    return drift_report_long(long_form(baseline, cols), long_form(current, cols),
                             threshold, bins, method, accuracy)


def psi(baseline: DataFrame, current: DataFrame, col: str, bins: int = DEFAULT_BINS) -> DataFrame:
    """PSI of one column: one row ``psi``."""
    return psi_long(long_form(baseline, [col]), long_form(current, [col]), bins).select("psi")


def drift_summary(report: DataFrame) -> DataFrame:
    """Roll-up: ``n_features, n_drifted, max_psi, any_drift``."""
    return report.agg(F.count(F.lit(1)).alias("n_features"),
                      F.count(F.when(F.col("drift"), F.lit(1))).alias("n_drifted"),
                      F.max("psi").alias("max_psi"),
                      F.coalesce(F.bool_or("drift"), F.lit(False)).alias("any_drift"))


EDGE_SCHEMA = T.StructType([T.StructField("feature", T.StringType()),
                            T.StructField("edges", T.ArrayType(T.DoubleType()))])
