"""Snapshot tables under concurrent writers, the resumable retrain chain, keyed permutations."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.operators import chain, features, registry, sample
from keelson.operators.snapshots import SnapshotTable
from keelson.plans import catalog
from keelson.plans.fixtures import CATEGORICAL, FEATURES, NUMERIC, model_rows
from keelson.session import scratch_path
from tests.conftest import SMALL


def run_rows(spark, names):
    return spark.createDataFrame(
        [(f"r-{n}", None, "e", n, {}, {"f1": 0.5}, i, None) for i, n in enumerate(names)], registry.RUN_SCHEMA)


def together(*jobs):
    failed = []

    def guarded(job):
        try:
            job()
        except Exception as e:  # noqa: BLE001 - raised below, in the test's thread
            failed.append(e)

    threads = [threading.Thread(target=guarded, args=(j,)) for j in jobs]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if failed:
        raise failed[0]


def test_concurrent_run_logs_lose_and_repeat_nothing(spark):
    path = scratch_path(spark, "t-runs")
    batches = [["a", "b", "c"], ["c", "d"], ["b", "e"], ["a"]]
    together(*[lambda b=b: registry.run_log(run_rows(spark, b), path) for b in batches])
    stored = registry.runs_table(spark, path)
    assert sorted(r.run_id for r in stored.read().collect()) == ["r-a", "r-b", "r-c", "r-d", "r-e"]
    assert stored.version() == 4


def test_concurrent_promotions_leave_one_production_version(spark):
    path = scratch_path(spark, "t-versions")
    together(*[lambda r=r: registry.promote(spark, path, "m", r) for r in ("x", "y", "z")])
    rows = registry.versions_table(spark, path).read().collect()
    assert sorted(r.version for r in rows) == [1, 2, 3] and {r.run_id for r in rows} == {"x", "y", "z"}
    assert [r.version for r in rows if r.stage == registry.PRODUCTION] == [3]
    last = registry.production_run(spark, path, "m")
    assert len(registry.promote(spark, path, "m", last).collect()) == 3  # a retry makes no second version


def test_an_entry_is_created_once(spark):
    table = SnapshotTable(spark, scratch_path(spark, "t-once"), registry.VERSION_SCHEMA)
    assert table.version() == 0 and table.read().collect() == []
    won = []
    together(*[lambda: won.append(table._create(1, ["data/p"])) for _ in range(8)])
    assert sorted(won) == [False] * 7 + [True] and table.version() == 1


def test_chain_resumes_after_each_stage(spark):
    rows = model_rows(spark, SMALL)
    root = scratch_path(spark, "t-chain")
    prep = features.feature_pipeline(NUMERIC, CATEGORICAL, FEATURES)
    source = [f"{SMALL}/orders.parquet"]

    def stages(**params):
        return chain.retrain_stages(spark, rows, prep, root, "m", "e", maxIter=20, regParam=params.pop("regParam", 0.1))

    def failing(at):
        out = stages()
        real = out[at].run

        def run(done, path):
            real(done, path)  # killed after its work, before it is recorded
            raise KeyboardInterrupt

        out[at].run = run
        return out

    for at in range(4):
        with pytest.raises(KeyboardInterrupt):
            chain.run_chain(spark, root, failing(at), source)
        recorded = SnapshotTable(spark, f"{root}/stages", chain.STAGE_SCHEMA).read().count()
        assert recorded == at
        if at < 3:
            assert [r["ran"] for r in chain.run_chain(spark, root, stages()[: at + 1], source)] == [False] * at + [True]
    done = chain.retrain(spark, root, stages(), source, "m").orderBy("seq").collect()
    assert [(r.stage, r.ran) for r in done] == [("split", False), ("train", False), ("evaluate", False), ("register", True)]
    # The interrupted registration had done its work: its run and version are there once.
    assert registry.runs_table(spark, f"{root}/runs").read().count() == 1
    assert [r.version for r in registry.versions_table(spark, f"{root}/versions").read().collect()] == [1]
    other = chain.retrain(spark, root, stages(regParam=0.5), source, "m").orderBy("seq").collect()
    assert [r.ran for r in other] == [False, True, True, True] and {r.version for r in other} == {2}


def test_permutation_does_not_depend_on_the_layout(spark):
    rows = spark.range(500).select("id", (F.col("id") % 3 == 0).alias("g"), F.lit(1).alias("n"))
    got = [{(r.id, r.position) for r in sample.shuffle_rows(rows.repartition(n), 7, key="id").collect()} for n in (1, 9)]
    assert got[0] == got[1] and sorted(p for _, p in got[0]) == list(range(500))
    assert abs(np.corrcoef(*zip(*got[0]))[0, 1]) < 0.2
    train, test = sample.split_random(rows, 0.3, 5, key="id", by=("g",))
    assert {r.g: r["count"] for r in test.groupBy("g").count().collect()} == {True: 50, False: 100}
    assert train.count() == 350 and train.columns == rows.columns and not set(train.collect()) & set(test.collect())
    assert sample.shuffle_rows(rows.limit(0), 7, key="id").collect() == []


def test_null_groups_and_keys(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, None), (None, None)], "id long, g string")
    placed = sample.positions(rows, "id", by=("g",)).collect()
    assert sorted((r.g or "", r.position) for r in placed) == [("", 0), ("", 1), ("", 2), ("a", 0)]


def test_retrain_chain_query_runs_each_stage_once(spark):
    rows = catalog.QUERIES["retrain_chain"](spark, SMALL).collect()
    assert [r.ran for r in rows] == [True] * 4 + [False] * 4 and {r.version for r in rows} == {1}
