"""Drift of an arriving stream against a stored baseline profile.

The baseline is summed up once: edges, counts a bin and row counts of every
feature, a bounded table that is stored and read back by the streaming job.
The stream is unpivoted to ``(time, feature, x)`` and counted by event-time
window, feature and bin with one stateful aggregate (map-side combined; its
state is a row of bin counts for each open window and feature). PSI is then an
expression over that row: the same value as batch ``drift_report`` of the
window's rows.

Every micro-batch writes the windows that it changed to a folder named after
the batch, overwriting it, so a batch that runs again after a failure leaves
no second copy; ``window_drift`` reads the newest row of each window. A window
is readable while it is open. Rows older than the watermark find their window
closed and are not counted (``numRowsDroppedByWatermark`` of the query's
progress tells how many); choose the delay accordingly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from keelson.operators import drift
from keelson.operators.quantiles import DEFAULT_ACCURACY, quantile_summary

PROFILE_SCHEMA = "feature string, edges array<double>, counts array<bigint>, n bigint, n_all bigint"


def baseline_profile(base_long: DataFrame, bins: int = drift.DEFAULT_BINS, accuracy: int = DEFAULT_ACCURACY) -> DataFrame:
    """``feature, edges, counts, n, n_all`` of the baseline: features x bins numbers. A feature without
    values has no edges, a constant one a single edge and no bins."""
    summary = quantile_summary(base_long, drift.quantile_grid(bins), accuracy=accuracy)
    edges = drift._summary_edges(summary)
    counts: dict[str, list[int]] = {}
    for feature, _, n in drift._baseline_bins(summary, edges):
        counts.setdefault(feature, []).append(n)
    rows = [(f, edges.get(f, []), counts.get(f, []), s.n, s.n_all) for f, s in summary.items()]
    return base_long.sparkSession.createDataFrame(rows, PROFILE_SCHEMA)


def _share(n, total):
    return F.greatest(F.when(total > 0, n.cast("double") / total.cast("double")).otherwise(F.lit(0.0)),
                      F.lit(drift.SHARE_FLOOR))


def windowed_drift(rows: DataFrame, profile: DataFrame, time_col: str, cols: Sequence[str], width: str,
                   delay: str | None = None, threshold: float = drift.DEFAULT_THRESHOLD) -> DataFrame:
    """``window_start, feature, n, n_all, psi, drift, null_share`` for each window of ``rows`` (streaming with a
    ``delay``, or batch) and feature; ``drift`` as in ``drift_report``."""
    known = {r["feature"]: r for r in profile.collect()}
    edges = {f: r["edges"] for f, r in known.items() if r["edges"]}
    n_bins = max((len(r["counts"]) for r in known.values()), default=0)
    timed = rows.select(F.col(time_col).cast("timestamp").alias("at"),
                        *[F.col(c).cast("double").alias(c) for c in cols])
    if delay is not None:
        timed = timed.withWatermark("at", delay)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("x")) for c in cols]))
    long = timed.select("at", pairs.alias("p")).select("at", "p.feature", "p.x")
    binned = long.select("at", "feature", drift._bin_column(edges).alias("bin"))
    counted = binned.groupBy(F.window("at", width), "feature").agg(
        F.count("bin").alias("n"), F.count(F.lit(1)).alias("n_all"),
        *[F.count(F.when(F.col("bin") == j, F.lit(1))).alias(f"bin_{j}") for j in range(n_bins)])
    psi, baseline = F.lit(0.0), F.lit(False)
    for f, r in known.items():
        total = sum(r["counts"])
        terms = F.lit(0.0)
        for j, e_n in enumerate(r["counts"]):
            a, e = _share(F.col(f"bin_{j}"), F.col("n")), F.lit(max(e_n / total, drift.SHARE_FLOOR))
            terms = terms + (a - e) * F.log(a / e)
        psi = F.when(F.col("feature") == f, terms).otherwise(psi)
        baseline = F.when(F.col("feature") == f, F.lit(r["n"] > 0)).otherwise(baseline)
    out = counted.select(F.col("window.start").alias("window_start"), "feature", "n", "n_all", psi.alias("psi"),
                         baseline.alias("_base"))
    return out.select(
        "window_start", "feature", "n", "n_all", "psi",
        ((F.col("psi") > F.lit(float(threshold))) | (F.col("_base") != (F.col("n") > 0))).alias("drift"),
        ((F.col("n_all") - F.col("n")).cast("double") / F.col("n_all")).alias("null_share"))


def drift_stream(spark: SparkSession, profile_path: str, source_dir: str, schema: StructType, time_col: str,
                 cols: Sequence[str], width: str, delay: str, sink_dir: str, checkpoint_dir: str,
                 threshold: float = drift.DEFAULT_THRESHOLD, max_files_per_trigger: int | None = None,
                 available_now: bool = True) -> StreamingQuery:
    """Start the query: Parquet files arriving in ``source_dir`` against the profile stored at ``profile_path``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    found = windowed_drift(reader.parquet(source_dir), spark.read.parquet(profile_path), time_col, cols, width, delay,
                           threshold)

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{sink_dir}/batch={batch}")

    writer = found.writeStream.outputMode("update").option("checkpointLocation", checkpoint_dir).foreachBatch(write)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def window_drift(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The newest row of every window and feature."""
    rows = spark.read.parquet(sink_dir)
    whole = F.struct(*[c for c in rows.columns if c not in ("window_start", "feature", "batch")])
    return (rows.groupBy("window_start", "feature").agg(F.max_by(whole, "batch").alias("r"))
            .select("window_start", "feature", "r.*"))
