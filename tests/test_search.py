"""The shared trainers of the model search against Spark's own fits, point by point."""

import threading

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from keelson.operators import forest, logistic, metrics, train
from keelson.plans import catalog
from tests.conftest import MEDIUM, SMALL


@pytest.fixture(scope="module")
def prepared(spark):
    return catalog._prepared(spark, SMALL)[1]


def grid_points():
    est = train.classifier("logreg")
    return [{p.name: v for p, v in m.items()} for m in train.param_grid(est, train.LR_GRID)]


def test_every_logistic_point_equals_its_own_fit(prepared):
    trainer = logistic.Trainer(prepared)
    points = grid_points()
    penalties = [logistic.Penalty.of(p["regParam"], p["elasticNetParam"]) for p in points]
    columns = trainer.fit(penalties, [0, 1, 2, logistic.ALL_ROWS], 200)
    # 7 different penalties on 4 sets of rows, and all of them in a few scans.
    assert len(columns) == 28 and trainer.scans <= 15
    for fold in (0, 1, 2, logistic.ALL_ROWS):
        rows = prepared.where(F.col("fold") != fold)
        for q in {penalties[i]: points[i] for i in range(len(points))} if fold == 1 else penalties[4:6]:
            want = LogisticRegression(regParam=q.reg, elasticNetParam=q.mix, maxIter=200, tol=1e-12).fit(rows)
            got = trainer.at_stop(columns[fold, q], 200)
            assert np.abs(want.coefficients.toArray() - got.coefficients).max() < 1e-6
            assert abs(want.intercept - got.intercept) < 1e-6


def test_coefficients_do_not_depend_on_the_layout(prepared):
    fits = [logistic.fit_logreg(prepared.repartition(n), regParam=0.01, elasticNetParam=0.5) for n in (1, 7)]
    assert np.abs(fits[0].coefficients - fits[1].coefficients).max() < 1e-11
    assert abs(fits[0].intercept - fits[1].intercept) < 1e-11


def test_iteration_limit_is_a_stop_on_the_path(prepared):
    trainer = logistic.Trainer(prepared, fold_col=None)
    (column,) = trainer.fit([logistic.Penalty.of(0.01)], max_iter=50).values()
    losses = []
    for stop in (0, 1, 2, 50):
        fit = trainer.at_stop(column, stop)
        assert fit.iterations == min(stop, len(column.path))
        model = logistic.to_model(fit)
        p = model.transform(prepared).select(vector_to_array("probability")[1].alias("p"), "label")
        losses.append(p.agg(F.avg(-F.log(F.when(F.col("label") == 1, F.col("p")).otherwise(1 - F.col("p"))))).first()[0])
    assert losses[0] == pytest.approx(np.log(2)) and losses[0] > losses[1] > losses[2] >= losses[3] - 1e-3


def test_awkward_features(spark):
    rows = [(Vectors.dense([float(i % 7), 5.0, float(i)]), float(i % 7 > 3 or i % 11 == 0)) for i in range(200)]
    table = spark.createDataFrame(rows, ["features", "label"])
    fit = logistic.fit_logreg(table, regParam=0.05)
    want = LogisticRegression(regParam=0.05, tol=1e-12, maxIter=500).fit(table)
    assert fit.coefficients[1] == 0 and np.abs(fit.coefficients - want.coefficients.toArray()).max() < 1e-5
    one_class = logistic.fit_logreg(table.withColumn("label", F.lit(1.0)))
    assert one_class.intercept > 10
    with pytest.raises(ValueError):
        logistic.fit_logreg(table.limit(0))
    nan = spark.createDataFrame([(Vectors.dense([float("nan")]), 1.0), (Vectors.dense([1.0]), 0.0)], ["features", "label"])
    with pytest.raises(ValueError):
        logistic.fit_logreg(nan)


def test_smaller_forests_follow_from_the_largest(prepared):
    rows, held_out = prepared.where("fold != 1"), prepared.where("fold = 1")
    grown = train.classifier("random_forest", numTrees=8, maxDepth=9).fit(rows)
    points = [(8, d) for d in (0, 1, 3, 5, 9)] + [(3, 5)]
    got = forest.evaluate(grown, held_out, points)
    for (trees, depth), counts in zip(points[:5], got):
        own = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=train.SEED).fit(rows).transform(held_out)
        want = np.zeros((2, 2), int)
        for r in own.groupBy("label", "prediction").count().collect():
            want[int(r["label"]), int(r["prediction"])] = r["count"]
        assert counts.tolist() == want.tolist()
    assert got[5].sum() == held_out.count()


def test_node_table_gives_the_models_probability(spark, prepared):
    model = train.classifier("random_forest", numTrees=5, maxDepth=6).fit(prepared)
    rows = model.transform(prepared).select(F.monotonically_increasing_id().alias("id"), "features", "probability").persist()
    walked = forest.score_nodes(rows.withColumn("x", vector_to_array("features")), forest.forest_nodes(spark, model), 6)
    both = rows.select("id", vector_to_array("probability")[1].alias("p")).join(walked, "id")
    worst, n = both.agg(F.max(F.abs(F.col("p") - F.col("probability"))), F.count("*")).first()
    assert worst < 1e-12 and n == rows.count()


def test_points_that_cannot_share_a_fit(prepared):
    found = train.cross_validate(prepared, "random_forest", {"numTrees": [1, 4], "maxDepth": [2], "minInstancesPerNode": [1, 50]})
    assert len(found.points) == 4 and all(0 < m < 1 for m in found.means)
    assert type(found.fit_best()).__name__ == "RandomForestClassificationModel"
    each = train.cross_validate(prepared, "logreg", {"tol": [1e-6], "regParam": [0.0, 0.1]})
    shared = train.cross_validate(prepared, "logreg", {"regParam": [0.0, 0.1]})
    assert each.scans is None and shared.scans <= 15
    assert each.means == pytest.approx(shared.means, abs=5e-3)


def test_f1_of_counts_equals_the_evaluator(spark):
    rows = [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 2 + [(1.0, 0.0)] * 3 + [(1.0, 1.0)] * 7
    want = MulticlassClassificationEvaluator(metricName="f1").evaluate(spark.createDataFrame(rows, "label double, prediction double"))
    assert metrics.weighted_f1_of([[5, 2], [3, 7]]) == pytest.approx(want, abs=1e-12)
    assert metrics.weighted_f1_of([[0, 0], [0, 0]]) == 0.0


def test_prepared_rows_are_spread_over_the_cores(spark):
    assert catalog._prepared(spark, MEDIUM)[1].rdd.getNumPartitions() >= min(2, spark.sparkContext.defaultParallelism)


def test_forests_keep_node_ids_and_grow_the_same_trees(prepared):
    own = train.classifier("random_forest", numTrees=6, maxDepth=9)
    assert own.getCacheNodeIds()
    plain = RandomForestClassifier(numTrees=6, maxDepth=9, seed=train.SEED).fit(prepared)
    tree_lines = lambda m: m.toDebugString.split("\n")[1:]
    assert tree_lines(own.fit(prepared)) == tree_lines(plain)


def test_large_forests_grow_one_at_a_time(prepared, monkeypatch):
    growing, most, lock, classifier = [], [], threading.Lock(), train.classifier

    class Watched:
        def __init__(self, *args, **params):
            self.own = classifier(*args, **{**params, "maxDepth": 1})

        def fit(self, rows):
            with lock:
                growing.append(1)
                most.append(len(growing))
            try:
                return self.own.fit(rows)
            finally:
                with lock:
                    growing.pop()

    monkeypatch.setattr(train, "classifier", Watched)
    monkeypatch.setattr(train, "GROWING_NODES", 100_000, raising=False)
    found = train.cross_validate(prepared, "random_forest", {"numTrees": [100], "maxDepth": [15]})
    assert len(most) == train.FOLDS and max(most) == 1 and 0 < found.means[0] < 1


def test_a_forest_written_in_parts_has_the_same_nodes(spark, prepared, monkeypatch):
    rows, held_out = prepared.where("fold != 1"), prepared.where("fold = 1")
    model = train.classifier("random_forest", numTrees=7, maxDepth=7).fit(rows)
    listed = lambda: sorted(map(repr, forest.forest_nodes(spark, model).collect()))
    points = [(7, 7), (3, 4), (1, 7)]
    whole, counts = listed(), forest.evaluate(model, held_out, points)
    monkeypatch.setattr(forest, "PART_NODES", 100)
    assert len(list(forest._parts(model))) > 2
    assert listed() == whole and forest.evaluate(model, held_out, points).tolist() == counts.tolist()


def test_rows_go_to_the_leaves_that_the_model_says(spark, prepared):
    model = train.classifier("random_forest", numTrees=5, maxDepth=8).fit(prepared).setLeafCol("leaf")
    nodes = forest.NodeArrays(forest.forest_nodes(spark, model))
    odd = [Vectors.dense([float(v), 6.5, 3000.0, c, c]) for v in (-1, 150, 1e9) for c in (0.0, 2.0, 7.0, -1.0, 1.5)]
    for table in (prepared.limit(500), spark.createDataFrame([(x,) for x in odd], ["features"])):
        said = model.transform(table).select("features", "leaf").collect()
        at = forest.leaves_of(nodes, np.array([r["features"].toArray() for r in said]))
        # Spark numbers the leaves of a tree from left to right.
        number = np.cumsum(nodes.left < 0) - 1
        first = number[[np.flatnonzero((np.arange(len(number)) >= b) & (nodes.left < 0))[0] for b in nodes.begin[:-1]]]
        assert (number[at] - first == np.array([r["leaf"].toArray() for r in said])).all()
