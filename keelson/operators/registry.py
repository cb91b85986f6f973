"""Run log, best-run lookup, model versions and the retrain gate as tables.

Runs and model versions are snapshot tables (``snapshots``): Parquet has no
update, so appending runs or promoting a version commits a new snapshot, and
of two writers at once the second starts again from the first one's. A
version snapshot is computed by one projection plus a one-row aggregate (no
join).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators.snapshots import SnapshotTable

RUN_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("parent_run_id", T.StringType(), True),
    T.StructField("experiment", T.StringType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("params", T.MapType(T.StringType(), T.StringType()), True),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), True),
    T.StructField("seq", T.LongType(), False),
    T.StructField("model_path", T.StringType(), True),
])

VERSION_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("version", T.IntegerType(), False),
    T.StructField("stage", T.StringType(), False),
    T.StructField("run_id", T.StringType(), True),
])

# Registry stages.
PRODUCTION = "Production"
ARCHIVED = "Archived"
NONE_STAGE = "None"


def run_id(experiment, name) -> F.Column:
    """Deterministic run id: md5 of ``experiment:name``."""
    return F.md5(F.concat_ws(":", experiment, name))


def runs_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, RUN_SCHEMA)


def versions_table(spark: SparkSession, path: str) -> SnapshotTable:
    return SnapshotTable(spark, path, VERSION_SCHEMA)


def run_log(runs: DataFrame, path: str) -> DataFrame:
    """Append run rows (``RUN_SCHEMA``) to the runs table at ``path`` and
    return the table as now stored. A run id that is stored already is not
    written again, so a retried driver leaves one row for each run, and so do
    writers that log at the same time."""
    table = runs_table(runs.sparkSession, path)
    new = runs.select(*[F.col(f.name).cast(f.dataType) for f in RUN_SCHEMA.fields]).dropDuplicates(["run_id"])
    table.commit(lambda stored: new.join(stored.select("run_id"), "run_id", "left_anti"), append=True)
    return table.read()


def runs_from_trials(trials: DataFrame, experiment: str, parent: str = "search",
                     model_path: str | None = None) -> DataFrame:
    """Cross-validation trials (``train.TRIAL_SCHEMA``) as child run rows of
    one parent run: params from the trial's JSON, metrics ``cv_f1`` and
    ``cv_f1_std``, ``seq`` in algorithm then grid order."""
    exp = F.lit(experiment)
    name = F.concat_ws("_", F.col("algorithm"), F.lit("cv_trial"), F.col("trial").cast("string"))
    params = F.map_concat(F.from_json("params", "map<string,string>"),
                          F.create_map(F.lit("algorithm"), F.col("algorithm")))
    metrics = F.map_from_arrays(F.array(F.lit("cv_f1"), F.lit("cv_f1_std")),
                                F.array(F.col("cv_f1"), F.col("cv_f1_std")))
    seq = (F.col("algorithm_order").cast("long") * F.lit(1_000_000) + F.col("trial").cast("long"))
    return trials.select(run_id(exp, name).alias("run_id"), run_id(exp, F.lit(parent)).alias("parent_run_id"),
                         exp.alias("experiment"), name.alias("name"), params.alias("params"),
                         metrics.alias("metrics"), seq.alias("seq"), F.lit(model_path).cast("string").alias("model_path"))


def best_run(runs: DataFrame, experiment: str, metric: str) -> DataFrame:
    """Top run of one experiment by ``metric`` (desc), newest first on ties,
    then smallest run id. Runs whose metric is missing or NaN never win."""
    m = F.col("metrics")[metric]
    return (runs.where((F.col("experiment") == experiment) & m.isNotNull() & ~F.isnan(m))
            .orderBy(m.desc(), F.desc("seq"), F.asc("run_id")).limit(1))


def best_run_checked(runs: DataFrame, experiment: str, metric: str):
    """Like ``best_run`` but raises when no run carries the metric."""
    row = best_run(runs, experiment, metric).first()
    if row is None:
        raise LookupError(f"no run in experiment {experiment!r} has metric {metric!r}")
    return row


def best_runs_per_experiment(runs: DataFrame, metric: str) -> DataFrame:
    """Best run of every experiment at once with ``min_by`` over an ordering
    key (metric desc, seq desc, run_id asc): a grouped aggregate with a
    map-side partial step, no window holding an experiment's runs."""
    m = F.col("metrics")[metric]
    key = F.struct((-m).alias("m"), (-F.col("seq")).alias("s"), F.col("run_id").alias("r"))
    return (runs.where(m.isNotNull() & ~F.isnan(m)).groupBy("experiment")
            .agg(F.min_by(F.struct("run_id", "name", m.alias(metric)), key).alias("best"))
            .select("experiment", "best.*"))


def register_versions(runs: DataFrame, model_name: str) -> DataFrame:
    """Versions table with one version per run in ``seq`` order (version =
    seq + 1); version 1 starts in Production, the rest in stage None."""
    v = (F.col("seq") + 1).cast("int")
    return runs.select(F.lit(model_name).alias("name"), v.alias("version"),
                       F.when(v == 1, F.lit(PRODUCTION)).otherwise(F.lit(NONE_STAGE)).alias("stage"),
                       F.col("run_id"))


def promote_version(versions: DataFrame, model_name: str, run: str | DataFrame) -> DataFrame:
    """New snapshot: the run becomes version ``max + 1`` in Production and
    every other Production version of that model is Archived.

    ``run`` is a run id, or a one-row DataFrame with a ``run_id`` column
    (e.g. ``best_run(...)``); then the id stays inside the plan as a scalar
    subquery and never passes through the driver.
    """
    same = F.col("name") == model_name
    updated = versions.withColumn(
        "stage", F.when(same & (F.col("stage") == PRODUCTION), F.lit(ARCHIVED)).otherwise(F.col("stage")))
    run_col = F.lit(run) if isinstance(run, str) else run.select("run_id").scalar()
    new = (versions.where(same)
           .agg((F.coalesce(F.max("version"), F.lit(0)) + 1).cast("int").alias("version"))
           .select(F.lit(model_name).alias("name"), "version", F.lit(PRODUCTION).alias("stage"),
                   run_col.alias("run_id")))
    return updated.unionByName(new)


def store_versions(versions: DataFrame, path: str) -> None:
    """Start the versions table at ``path``; does nothing to one that has rows."""
    table = versions_table(versions.sparkSession, path)
    if not table.version():
        table.commit(lambda stored: versions if stored.limit(1).count() == 0 else stored)


def promote(spark: SparkSession, path: str, model_name: str, run: str | DataFrame) -> DataFrame:
    """``promote_version`` on the stored table: commits the new snapshot and returns it. Where the newest
    version is this run's and in Production nothing changes, so a retried driver makes no second version."""
    table = versions_table(spark, path)

    def change(stored: DataFrame) -> DataFrame:
        wanted = run if isinstance(run, str) else run.select("run_id").first()[0]
        newest = stored.where(F.col("name") == model_name).orderBy(F.desc("version")).first()
        again = newest is not None and (newest["stage"], newest["run_id"]) == (PRODUCTION, wanted)
        return stored if again else promote_version(stored, model_name, wanted)

    table.commit(change)
    return table.read()


def production_run(spark: SparkSession, path: str, model_name: str) -> str | None:
    """The run id of the Production version."""
    rows = versions_table(spark, path).read()
    found = rows.where((F.col("name") == model_name) & (F.col("stage") == PRODUCTION)).select("run_id").first()
    return found and found[0]


def production_model(spark: SparkSession, versions_path: str, runs_path: str, model_name: str) -> tuple[int, str]:
    """Version and model path of the Production version."""
    version = versions_table(spark, versions_path).read().where(
        (F.col("name") == model_name) & (F.col("stage") == PRODUCTION)).select("version", "run_id")
    found = version.join(runs_table(spark, runs_path).read().select("run_id", "model_path"), "run_id").first()
    if found is None:
        raise LookupError(f"model {model_name!r} has no Production version")
    return found["version"], found["model_path"]


def retrain_decision(drift: DataFrame, enabled: bool = True) -> DataFrame:
    """One row: ``any_drift, retrain_enabled, decision`` from a drift report."""
    any_drift = F.coalesce(F.bool_or("drift"), F.lit(False))
    return drift.agg(any_drift.alias("any_drift")).select(
        "any_drift", F.lit(enabled).alias("retrain_enabled"),
        F.when(F.lit(enabled) & F.col("any_drift"), F.lit("retrain")).otherwise(F.lit("keep")).alias("decision"))


def retrain_gate(drift: DataFrame, enabled: bool, retrain: Callable[[], object]):
    """Run ``retrain`` when enabled and any feature drifted; return
    ``(decision_row, result_or_None)``. Only the one decision row reaches the
    driver."""
    row = retrain_decision(drift, enabled).first()
    return row, (retrain() if row["decision"] == "retrain" else None)
