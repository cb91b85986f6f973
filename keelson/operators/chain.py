"""The retrain chain: split, train, evaluate, register, each stage resumable.

A stage has a fingerprint of its parameters, the input files (path, size and
time of change) and the fingerprint of the stage before it. What a stage made
is recorded in a snapshot table once it is whole, so a chain that is started
again after a failure, or with nothing changed, takes recorded results and
runs the rest only.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import metrics, registry, sample, train
from keelson.operators.snapshots import SnapshotTable

STAGE_SCHEMA = T.StructType([
    T.StructField("stage", T.StringType()),
    T.StructField("fingerprint", T.StringType()),
    T.StructField("output", T.StringType()),
])


@dataclass
class Stage:
    """``run(outputs of the stages before, path to write below) -> output``, a path or another short text."""

    name: str
    run: Callable[[dict[str, str], str], str]
    params: dict = field(default_factory=dict)


def files_of(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, int, int]]:
    """Path, size and time of change of every file below ``paths``."""
    out = []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        listing = p.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(p, True)
        while listing.hasNext():
            s = listing.next()
            out.append((s.getPath().toString(), s.getLen(), s.getModificationTime()))
    return sorted(out)


def run_chain(spark: SparkSession, root: str, stages: Sequence[Stage], inputs: Sequence[str]) -> list[dict]:
    """Run the stages that have no recorded result; one ``{stage, fingerprint, output, ran}`` for each."""
    table = SnapshotTable(spark, f"{root}/stages", STAGE_SCHEMA)
    done = {(r["stage"], r["fingerprint"]): r["output"] for r in table.read().collect()}  # a row a stage and change
    before = hashlib.sha256(json.dumps(files_of(spark, inputs)).encode()).hexdigest()
    outputs: dict[str, str] = {}
    report = []
    for s in stages:
        text = json.dumps([s.name, s.params, before], sort_keys=True)
        before = hashlib.sha256(text.encode()).hexdigest()
        ran = (s.name, before) not in done
        if ran:
            output = s.run(outputs, f"{root}/{s.name}-{before[:16]}")
            row = spark.createDataFrame([(s.name, before, output)], STAGE_SCHEMA)
            table.commit(lambda stored, row=row: row, append=True)
        else:
            output = done[s.name, before]
        outputs[s.name] = output
        report.append({"stage": s.name, "fingerprint": before, "output": output, "ran": ran})
    return report


def retrain_stages(spark: SparkSession, rows: DataFrame, prep: Pipeline, root: str, model_name: str, experiment: str,
                   algorithm: str = "logreg", id_col: str = "id", test_size: float = 0.2, seed: int = 42,
                   **params) -> list[Stage]:
    """Split ``rows``, fit ``prep`` and a classifier, evaluate on the test rows, log the run and promote its model."""

    def split(_: dict[str, str], path: str) -> str:
        for name, part in zip(("train", "test"), sample.split_hash(rows, id_col, test_size, seed)):
            part.write.mode("overwrite").parquet(f"{path}/{name}")
        return path

    def fit(done: dict[str, str], path: str) -> str:
        stages = list(prep.getStages()) + [train.classifier(algorithm, **params)]
        Pipeline(stages=stages).fit(spark.read.parquet(f"{done['split']}/train")).write().overwrite().save(path)
        return path

    def evaluate(done: dict[str, str], path: str) -> str:
        test = spark.read.parquet(f"{done['split']}/test")
        metrics.evaluate_model(PipelineModel.load(done["train"]), test, algorithm).write.mode("overwrite").parquet(path)
        return path

    def register(done: dict[str, str], path: str) -> str:
        found = spark.read.parquet(done["evaluate"])
        name = done["train"].rsplit("/", 1)[-1]  # holds the fingerprint: one run for each fitted model
        run = registry.run_id(F.lit(experiment), F.lit(name))
        logged = registry.runs_table(spark, f"{root}/runs").read().count()
        registry.run_log(found.select(
            run.alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"), F.lit(experiment).alias("experiment"),
            F.lit(name).alias("name"), F.create_map(*[F.lit(str(x)) for kv in {"algorithm": algorithm, **params}.items() for x in kv]).alias("params"),
            F.create_map(F.lit("f1"), F.col("f1"), F.lit("accuracy"), F.col("accuracy")).alias("metrics"),
            F.lit(logged).cast("long").alias("seq"), F.lit(done["train"]).alias("model_path")), f"{root}/runs")
        run_id = hashlib.md5(f"{experiment}:{name}".encode()).hexdigest()
        registry.promote(spark, f"{root}/versions", model_name, run_id)
        return run_id

    setup = {"algorithm": algorithm, "params": {k: str(v) for k, v in params.items()}}
    return [Stage("split", split, {"test_size": test_size, "seed": seed}), Stage("train", fit, setup),
            Stage("evaluate", evaluate), Stage("register", register, {"model": model_name, "experiment": experiment})]


def retrain(spark: SparkSession, root: str, stages: Sequence[Stage], inputs: Sequence[str], model_name: str) -> DataFrame:
    """``seq, stage, ran`` for each stage, with the Production version and its run's metrics."""
    report = run_chain(spark, root, stages, inputs)
    version = registry.versions_table(spark, f"{root}/versions").read().where(
        (F.col("name") == model_name) & (F.col("stage") == registry.PRODUCTION))
    run = registry.runs_table(spark, f"{root}/runs").read().join(version, "run_id")
    row = run.select("version", F.col("metrics")["f1"].alias("f1"), F.col("metrics")["accuracy"].alias("accuracy")).first()
    rows = [(i, r["stage"], r["ran"], row["version"], row["f1"], row["accuracy"]) for i, r in enumerate(report, 1)]
    return spark.createDataFrame(rows, "seq int, stage string, ran boolean, version int, f1 double, accuracy double")
