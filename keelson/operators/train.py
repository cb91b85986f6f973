"""Model training and selection.

* Preprocessing is fitted once on the training split (no test leakage); the
  prepared training set is persisted because every scan of the search reads
  it again. ``persist`` rather than a reliable checkpoint: its lineage
  is a scan plus row-wise transforms (no shuffle), so a partition lost with
  an executor is recomputed from its own file split at the cost of one
  task, while a checkpoint would write the whole training set once more.
* Folds come from a keyed hash column (``foldCol``), so they do not depend on
  the partition layout and survive recomputation after executor loss.
* A grid is searched as a whole, not point by point. Logistic regression: all
  penalties, folds and iteration limits share the same scans
  (``keelson.operators.logistic``). Random forests: one forest a fold, with the
  most trees and the greatest depth, answers for all smaller ones
  (``keelson.operators.forest``). Other parameters make groups of points;
  grids that neither can share are fitted point by point by Spark's
  cross-validator.
* The model is chosen on the cross-validated mean metric; the test split only
  reports. Ties keep the earlier algorithm and the earlier grid point.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.param.shared import HasElasticNetParam, HasFeaturesCol, HasLabelCol, HasMaxIter, HasRegParam
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.operators import forest, logistic
from keelson.operators.metrics import evaluate_model, evaluate_models, weighted_f1_of
from keelson.operators.sample import kfold_assign

ALGORITHMS = ("logreg", "random_forest")

# The full search space of the surveyed configuration.
LR_GRID = {"maxIter": [50, 100, 200], "regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5, 1.0]}
RF_GRID = {"numTrees": [10, 50, 100], "maxDepth": [5, 10, 15]}
FOLDS = 3
SEED = 42
#: The driver holds the nodes of the forests that grow at the same time, some 400 bytes each.
GROWING_NODES = 1 << 20

TRIAL_SCHEMA = T.StructType([
    T.StructField("algorithm", T.StringType()),
    T.StructField("algorithm_order", T.IntegerType()),
    T.StructField("trial", T.IntegerType()),
    T.StructField("params", T.StringType()),
    T.StructField("cv_f1", T.DoubleType()),
    T.StructField("cv_f1_std", T.DoubleType()),
])


class NewtonLogisticRegression(Estimator, HasFeaturesCol, HasLabelCol, HasMaxIter, HasRegParam, HasElasticNetParam):
    """Binomial logistic regression fitted to its optimum; gives Spark's ``LogisticRegressionModel``.

    Tables wider than ``logistic.MAX_FEATURES`` go to Spark's own solver.
    """

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label", maxIter: int = 100,
                 regParam: float = 0.0, elasticNetParam: float = 0.0):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", maxIter=100, regParam=0.0, elasticNetParam=0.0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        features, label = self.getFeaturesCol(), self.getLabelCol()
        params = {"maxIter": self.getMaxIter(), "regParam": self.getRegParam(), "elasticNetParam": self.getElasticNetParam()}
        if (width(dataset, features) or 0) > logistic.MAX_FEATURES:
            return LogisticRegression(featuresCol=features, labelCol=label, family="binomial", **params).fit(dataset)
        return logistic.to_model(logistic.fit_logreg(dataset, features, label, **params), features, label, **params)


def width(prepared: DataFrame, features_col: str = "features") -> int | None:
    """How many features a table has, by its metadata; None where that is silent."""
    return prepared.schema[features_col].metadata.get("ml_attr", {}).get("num_attrs")


def classifier(algorithm: str, label_col: str = "label", features_col: str = "features",
               seed: int = SEED, **params):
    if algorithm == "logreg":
        return NewtonLogisticRegression(featuresCol=features_col, labelCol=label_col, **params)
    if algorithm == "random_forest":
        # With the node of every row kept, tasks need not get all trees at each level; the trees are the same.
        params.setdefault("cacheNodeIds", True)
        return RandomForestClassifier(featuresCol=features_col, labelCol=label_col, seed=seed, **params)
    raise ValueError(f"unknown algorithm {algorithm!r}; use one of {ALGORITHMS}")


def param_grid(estimator, grid: Mapping[str, object]) -> list:
    """Cartesian product of the values; a scalar counts as a one-value list."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        vals = list(values) if isinstance(values, (list, tuple)) else [values]
        builder.addGrid(estimator.getParam(name), vals)
    return builder.build()


def f1_evaluator(label_col: str = "label") -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(labelCol=label_col, metricName="f1")


def train_logreg(train: DataFrame, label_col: str = "label", **params):
    return classifier("logreg", label_col, **params).fit(train)


def bins_for(prepared: DataFrame, features_col: str = "features", least: int = 32) -> int:
    """``maxBins`` of a forest: as many as the largest categorical feature has values (from its metadata)."""
    attrs = prepared.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {})
    sizes = [len(a.get("vals", ())) or a.get("num_vals", 0) for a in attrs.get("nominal", ())]
    return max([least, *sizes])


def train_random_forest(train: DataFrame, label_col: str = "label", seed: int = SEED, **params):
    params.setdefault("maxBins", bins_for(train))
    return classifier("random_forest", label_col, seed=seed, **params).fit(train)


def prepare(prep: Pipeline, raw_train: DataFrame, id_col: str = "id", folds: int = FOLDS,
            fold_seed: int = SEED + 1) -> tuple[PipelineModel, DataFrame]:
    """Fit preprocessing on the training rows and return the persisted
    ``(features, label, fold)`` table used by every later fit.

    A table of fewer files than the cluster has cores is spread over them by
    its key: every later scan of the search is as parallel as its partitions.
    """
    prep_model = prep.fit(raw_train)
    cores = raw_train.sparkSession.sparkContext.defaultParallelism
    if raw_train.rdd.getNumPartitions() < cores:
        raw_train = raw_train.repartition(cores, id_col)
    prepared = kfold_assign(prep_model.transform(raw_train), id_col, folds, fold_seed)
    return prep_model, prepared.select("features", "label", "fold").persist(StorageLevel.MEMORY_AND_DISK)


@dataclass
class Search:
    """What a cross-validated grid search found."""

    algorithm: str
    points: list[dict]
    means: list[float]  # of the folds' weighted F1, one for each point
    deviations: list[float]
    fit_best: Callable[[], object]
    scans: int | None = None  # of the table by the shared trainer

    @property
    def best(self) -> int:
        return max(range(len(self.points)), key=lambda i: self.means[i])  # ties keep the earlier point


def _points(est, grid: Mapping[str, object]) -> list[dict]:
    return [{p.name: v for p, v in m.items()} for m in param_grid(est, grid)]


def _search(algorithm: str, points: list[dict], f1: list[list[float]], fit: Callable[[dict], object], scans=None) -> Search:
    """``f1[fold][point]``."""
    table = np.array(f1)
    found = Search(algorithm, points, table.mean(axis=0).tolist(), table.std(axis=0).tolist(), lambda: None, scans)
    found.fit_best = lambda: fit(points[found.best])
    return found


def _search_logreg(prepared: DataFrame, points: list[dict], folds: int, fold_col: str, label_col: str) -> Search:
    trainer = logistic.Trainer(prepared, label_col=label_col, fold_col=fold_col)
    defaults = {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.0}
    full = [{**defaults, **p} for p in points]
    penalty = [logistic.Penalty.of(p["regParam"], p["elasticNetParam"]) for p in full]
    held = sorted(f for f in trainer.moments)
    columns = trainer.fit(penalty, [*held, logistic.ALL_ROWS], max(p["maxIter"] for p in full))
    # Points that stop at the same place of one path are rated once.
    where = {}
    for f in held:
        for p, q in zip(full, penalty):
            where.setdefault((f, q, min(p["maxIter"], len(columns[f, q].path))), len(where))
    fits = [(f, trainer.at_stop(columns[f, q], stop)) for f, q, stop in where]
    f1 = [weighted_f1_of(c) for c in trainer.confusion(fits)]
    rated = [[f1[where[f, q, min(p["maxIter"], len(columns[f, q].path))]] for p, q in zip(full, penalty)] for f in held]

    def fit(point: dict):
        p = {**defaults, **point}
        column = columns[logistic.ALL_ROWS, logistic.Penalty.of(p["regParam"], p["elasticNetParam"])]
        return logistic.to_model(trainer.at_stop(column, p["maxIter"]), label_col=label_col, **p)

    return _search("logreg", points, rated, fit, trainer.scans)


def _forests_at_once(points: list[dict], rows: int) -> int:
    """How many forests of these shapes on so many rows have ``GROWING_NODES`` nodes at most; at least one."""
    nodes = max(p["numTrees"] for p in points) * min(2 ** (max(p["maxDepth"] for p in points) + 1), 2 * max(1, rows))
    return max(1, GROWING_NODES // nodes)


def _search_forest(prepared: DataFrame, points: list[dict], folds: int, fold_col: str, seed: int, parallelism: int,
                   label_col: str) -> Search:
    spark = prepared.sparkSession
    defaults = {"numTrees": 20, "maxDepth": 5, "maxBins": bins_for(prepared)}
    full = [{**defaults, **p} for p in points]
    # Points that differ in trees and depth only share a forest; a single tree chooses its features in another way.
    groups: dict[str, list[int]] = {}
    for i, p in enumerate(full):
        rest = {k: v for k, v in p.items() if k not in ("numTrees", "maxDepth")}
        groups.setdefault(json.dumps([rest, p["numTrees"] == 1], sort_keys=True), []).append(i)

    def fit(point: dict, rows: DataFrame = prepared):
        return classifier("random_forest", label_col, seed=seed, **{**defaults, **point}).fit(rows)

    def rate(job: tuple[int, list[int]]) -> dict[int, float]:
        fold, members = job
        largest = {**full[members[0]], "numTrees": max(full[i]["numTrees"] for i in members),
                   "maxDepth": max(full[i]["maxDepth"] for i in members)}
        # The fitted forest goes as soon as its nodes are written: as arrays they are a small part of its size.
        grown = forest.forest_nodes(spark, fit(largest, prepared.where(F.col(fold_col) != fold)))
        forest.give_back(spark)
        nodes = forest.NodeArrays(grown)
        shapes = [(full[i]["numTrees"], full[i]["maxDepth"]) for i in members]
        counts = forest.evaluate_nodes(nodes, prepared.where(F.col(fold_col) == fold), shapes, label_col)
        del nodes
        forest.give_back(spark)
        return dict(zip(members, map(weighted_f1_of, counts)))

    jobs = [(f, members) for f in range(folds) for members in groups.values()]
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(jobs), _forests_at_once(full, prepared.count())))) as pool:
        rated = list(pool.map(rate, jobs))
    by_fold: list[dict[int, float]] = [{} for _ in range(folds)]
    for (fold, _), found in zip(jobs, rated):
        by_fold[fold].update(found)
    return _search("random_forest", points, [[found[i] for i in range(len(points))] for found in by_fold], fit)


def _search_each(prepared: DataFrame, algorithm: str, grid: Mapping[str, object], folds: int, fold_col: str | None,
                 seed: int, parallelism: int, label_col: str) -> Search:
    """Spark's cross-validator: every point and fold is a fit of its own."""
    est = LogisticRegression(labelCol=label_col, family="binomial") if algorithm == "logreg" else \
        classifier(algorithm, label_col, seed=seed).setMaxBins(bins_for(prepared))
    maps = param_grid(est, grid)
    cv = CrossValidator(estimator=est, estimatorParamMaps=maps, evaluator=f1_evaluator(label_col),
                        numFolds=folds, seed=seed, parallelism=max(1, min(parallelism, len(maps))))
    if fold_col is not None:
        cv = cv.setFoldCol(fold_col)
    fitted = cv.fit(prepared)
    return Search(algorithm, [{p.name: v for p, v in m.items()} for m in maps], list(fitted.avgMetrics),
                  list(fitted.stdMetrics), lambda: fitted.bestModel)


def cross_validate(prepared: DataFrame, algorithm: str, grid: Mapping[str, object],
                   folds: int = FOLDS, fold_col: str | None = "fold", seed: int = SEED,
                   parallelism: int = 4, label_col: str = "label") -> Search:
    """Rate every point of ``grid`` by its mean weighted F1 over the folds of ``fold_col`` (0 to ``folds`` - 1).

    Without a fold column, for parameters that the shared trainers don't know,
    and for tables too wide for them, every point is fitted on its own.
    """
    if algorithm not in ALGORITHMS:
        raise ValueError(f"unknown algorithm {algorithm!r}; use one of {ALGORITHMS}")
    if fold_col is not None and algorithm == "random_forest":
        points = _points(RandomForestClassifier(), grid)
        return _search_forest(prepared, points, folds, fold_col, seed, parallelism, label_col)
    known = set(grid) <= {"maxIter", "regParam", "elasticNetParam"}
    if fold_col is not None and known and (width(prepared) or 0) <= logistic.MAX_FEATURES:
        return _search_logreg(prepared, _points(NewtonLogisticRegression(), grid), folds, fold_col, label_col)
    return _search_each(prepared, algorithm, grid, folds, fold_col, seed, parallelism, label_col)


def cv_trials(found: Search, algorithm: str, algorithm_order: int = 0) -> DataFrame:
    """One row per grid point: params (JSON), mean and std of the fold metric."""
    spark = SparkSession.getActiveSession()
    rows = [(algorithm, algorithm_order, i + 1, json.dumps(p, sort_keys=True), float(mean), float(std))
            for i, (p, mean, std) in enumerate(zip(found.points, found.means, found.deviations))]
    return spark.createDataFrame(rows, TRIAL_SCHEMA)


def select_best(trials: DataFrame) -> DataFrame:
    """Top trial by CV mean; ties keep the earlier algorithm, then trial."""
    return trials.orderBy(F.desc("cv_f1"), F.asc("algorithm_order"), F.asc("trial")).limit(1)


def search(prepared: DataFrame, grids: Mapping[str, Mapping[str, object]], folds: int = FOLDS,
           parallelism: int = 4, label_col: str = "label") -> tuple[DataFrame, dict[str, Search]]:
    """Cross-validate every algorithm; returns ``(trials, {algorithm: Search})``.

    Algorithms are searched concurrently from driver threads (Spark runs
    jobs from several threads side by side).
    """
    items = list(grids.items())
    with ThreadPoolExecutor(max_workers=max(1, len(items))) as pool:
        futures = [pool.submit(cross_validate, prepared, algo, grid, folds, "fold", SEED, parallelism, label_col)
                   for algo, grid in items]
        found = {algo: f.result() for (algo, _), f in zip(items, futures)}
    trials = None
    for order, (algo, result) in enumerate(found.items()):
        t = cv_trials(result, algo, order)
        trials = t if trials is None else trials.unionByName(t)
    return trials, found


def select_best_model(prep: Pipeline, raw_train: DataFrame, test: DataFrame,
                      grids: Mapping[str, Mapping[str, object]], folds: int = FOLDS,
                      parallelism: int = 4, label_col: str = "label"):
    """Search all algorithms, pick on CV mean, report on the test split.

    Returns ``(best PipelineModel, summary DataFrame)``: one row per
    algorithm with its best CV score and its test metrics, plus which one
    won overall. The fitted pipeline includes preprocessing, so it scores
    raw rows.
    """
    prep_model, prepared = prepare(prep, raw_train)
    try:
        _, found = search(prepared, grids, folds, parallelism, label_col)
        pipelines = {a: PipelineModel(stages=list(prep_model.stages) + [s.fit_best()]) for a, s in found.items()}
    finally:
        prepared.unpersist()
    winner = max(found, key=lambda a: found[a].means[found[a].best])  # ties keep the earlier algorithm
    # All candidates are scored in one pass over the test rows.
    ev = evaluate_models(pipelines, test, label_col)
    best = {a: (json.dumps(s.points[s.best], sort_keys=True), float(s.means[s.best])) for a, s in found.items()}
    cv_params = F.create_map(*[x for a, (p, _) in best.items() for x in (F.lit(a), F.lit(p))])
    cv_score = F.create_map(*[x for a, (_, m) in best.items() for x in (F.lit(a), F.lit(m))])
    summary = ev.select("algorithm", cv_params[F.col("algorithm")].alias("params"),
                        cv_score[F.col("algorithm")].alias("cv_f1"),
                        F.col("f1").alias("test_f1"), F.col("accuracy").alias("test_accuracy"),
                        (F.col("algorithm") == F.lit(winner)).alias("selected"))
    return pipelines[winner], summary


def fit_pipeline(prep_stages: Sequence, algorithm: str, label_col: str = "label", **params) -> Pipeline:
    return Pipeline(stages=list(prep_stages) + [classifier(algorithm, label_col, **params)])


def train_single(prep_stages: Sequence, raw_train: DataFrame, test: DataFrame, algorithm: str,
                 label_col: str = "label", **params) -> tuple[PipelineModel, DataFrame]:
    """One algorithm, one configuration: fit, then f1 + accuracy on test."""
    model = fit_pipeline(prep_stages, algorithm, label_col, **params).fit(raw_train)
    return model, evaluate_model(model, test, algorithm, label_col)
