"""Drift of a stream against a stored profile; serving the Production model across a promotion."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from keelson.operators import aggregate, drift, features, registry, train
from keelson.plans.fixtures import CATEGORICAL, FEATURES, NUMERIC, model_rows
from keelson.session import scratch_path
from keelson.sources import files
from keelson.streaming import baseline_profile, drift_stream, serve_production, window_drift, windowed_drift
from tests.conftest import SMALL

START = dt.datetime(2024, 1, 1)


def finish(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def values(spark, rows):
    """Rows of (days after the start, x)."""
    return spark.createDataFrame([(START + dt.timedelta(days=d), x) for d, x in rows], "at timestamp, x double")


def test_stream_equals_batch_by_window_over_a_restart(spark):
    base = values(spark, [(0, float(i % 50)) for i in range(500)])
    profile = scratch_path(spark, "t-profile")
    baseline_profile(aggregate.long_form(base, ["x"])).write.parquet(profile)
    parts = [[(1 + i % 4, float(i % 70)) for i in range(400)], [(3, None), (3, float("nan")), *((4 + i % 3, i * 0.3) for i in range(90))]]
    source, sink, ckpt = (scratch_path(spark, f"t-{n}") for n in ("in", "out", "ckpt"))
    for part in parts:  # the second start goes on from the checkpoint: days 3 and 4 get rows of both
        values(spark, part).coalesce(1).write.mode("append").parquet(source)
        finish(drift_stream(spark, profile, source, base.schema, "at", ["x"], "1 day", "30 days", sink, ckpt))
    found = {r.window_start: r for r in window_drift(spark, sink).collect()}
    every = [row for part in parts for row in part]
    assert len(found) == 6
    for day in range(1, 7):
        r = found[START + dt.timedelta(days=day)]
        one = values(spark, [row for row in every if row[0] == day])
        want = drift.drift_report(base, one, ["x"]).first()
        assert r.psi == pytest.approx(want.psi, rel=1e-12) and r.drift == want.drift
        assert r.null_share == pytest.approx(want.null_share_current) and r.n_all == one.count()


def test_rows_behind_the_watermark_leave_closed_windows_alone(spark):
    profile = scratch_path(spark, "t-profile")
    base = values(spark, [(0, float(i)) for i in range(100)])
    baseline_profile(aggregate.long_form(base, ["x"])).write.parquet(profile)
    source, sink, ckpt = (scratch_path(spark, f"t-{n}") for n in ("in", "out", "ckpt"))
    dropped = 0
    for rows in ([(0, 1.0), (9, 1.0)], [(0, 2.0), (8, 2.0), (9, 2.0)]):  # day 0 closed, day 8 within the delay
        values(spark, rows).coalesce(1).write.mode("append").parquet(source)
        query = finish(drift_stream(spark, profile, source, base.schema, "at", ["x"], "1 day", "2 days", sink, ckpt))
        dropped += sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
    assert {(r.window_start - START).days: r.n for r in window_drift(spark, sink).collect()} == {0: 1, 8: 1, 9: 2}
    assert dropped == 1


def test_constant_empty_and_unknown_features(spark):
    rows = spark.createDataFrame([(START, 1.0, None, 5.0), (START, 1.0, None, 6.0)], "at timestamp, c double, e double, u double")
    profile = baseline_profile(aggregate.long_form(rows, ["c", "e"]))
    found = {r.feature: r for r in windowed_drift(rows, profile, "at", ["c", "e", "u"], "1 day").collect()}
    assert (found["c"].psi, found["c"].drift) == (0.0, False)
    assert (found["e"].psi, found["e"].drift, found["e"].null_share) == (0.0, False, 1.0)
    assert (found["u"].psi, found["u"].drift) == (0.0, True)  # values on one side only
    assert windowed_drift(rows.limit(0), profile, "at", ["c"], "1 day").count() == 0


def test_promotion_between_batches_and_resent_requests(spark):
    rows = model_rows(spark, SMALL).limit(60).cache()
    requests = rows.drop("label").withColumn("sent_at", F.lit(START).cast("timestamp"))
    runs, versions, source, sink, ckpt = (scratch_path(spark, f"t-{n}") for n in ("runs", "versions", "in", "out", "ckpt"))
    prep = features.prep_stages(NUMERIC, CATEGORICAL, FEATURES)
    ids = sorted(r.id for r in rows.select("id").collect())
    waves = [ids[:40], ids[20:]]  # twenty are sent twice
    scored = []
    for i, wave in enumerate(waves):
        model = train.fit_pipeline(prep, "logreg", maxIter=5, regParam=0.1 + i).fit(rows)
        path = files.save_model(model, scratch_path(spark, "t-model"))
        registry.run_log(spark.createDataFrame([(f"r{i}", None, "e", f"r{i}", {}, {}, i, path)], registry.RUN_SCHEMA), runs)
        registry.promote(spark, versions, "m", f"r{i}")
        part = requests.where(F.col("id").isin(wave))
        part.unionByName(part.limit(3)).write.mode("append").parquet(source)
        finish(serve_production(spark, versions, runs, "m", source, requests.schema, sink, ckpt))
        scored.append({r.id: r.probability[1] for r in model.transform(rows).collect()})
    got = spark.read.parquet(sink).collect()
    assert sorted(r.id for r in got) == ids
    assert {r.id: r.version for r in got} == {i: 1 if i in waves[0] else 2 for i in ids}
    assert all(abs(r.probability - scored[r.version - 1][r.id]) < 1e-12 for r in got)


def test_serving_without_a_production_version_fails(spark):
    with pytest.raises(LookupError):
        registry.production_model(spark, scratch_path(spark, "t-v"), scratch_path(spark, "t-r"), "m")
