"""Named queries: every operator of the toolkit applied to the input tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over whole
tables (or data Spark derives from them). Floating results that are compared
with the SQL twins in ``keelson.plans.sql`` are rounded to 6 decimals (PSI
values to 8) on both sides.

Queries that fit models or draw partition-dependent random numbers have no
SQL twin; their checks are row counts plus the invariants in ``tests/``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions import hash_unit
from keelson.operators import aggregate as agg
from keelson.operators import chain, clean, drift, features, forest, index_table, metrics, registry, sample, score, train
from keelson.plans.fixtures import (
    CATEGORICAL,
    EVENTS_CONTRACT,
    FEATURES,
    FOLD_SEED,
    INDEXED,
    NUMERIC,
    RAW_CONTRACT,
    SPLIT_SEED,
    dirty_events,
    drift_long_sides,
    model_rows,
    request_rows,
)
from keelson.session import scratch_path
from keelson.sources import files, inference
from keelson.streaming import baseline_profile, drift_stream, score_requests, score_stream, serve_production, window_drift

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Fixed values of the queries: split share, sample size, baseline moduli,
# the linear scorer's coefficients, the model-search grids of the registered
# queries (all 27 + 9 points; the small grids are for tests).
TEST_SIZE = 0.2
SAMPLE_SIZE = 1000
SAMPLE_SEED = 1
MOD_K = 3
MODEL_NAME = "classifier"
EXPERIMENT = "scorer-search"
# Coefficients in proportion to the label's formula.
LINEAR_INTERCEPT = 0.9
LINEAR_COEFFICIENTS = {
    "price": 0.018, "month": -0.9, "age_days": 0.0001, "priority_index": 0.05, "status_index": 0.01,
}
SMALL_LR_GRID = {"maxIter": [50], "regParam": [0.0, 0.01], "elasticNetParam": [0.0]}
SMALL_RF_GRID = {"numTrees": [10], "maxDepth": [5]}
SEARCH_GRIDS = {"logreg": train.LR_GRID, "random_forest": train.RF_GRID}
RUN_MODS = [2, 3, 4, 5, 6, 7]
# The served model before and after a promotion, and the drift stream's windows.
SERVED_REG = [0.01, 0.1]
RESENT_EVERY = 20
INDEX_NULL_EVERY = 23
DRIFT_BASELINE_END = "2024-01-11"
DRIFT_WINDOW = "5 days"
DRIFT_COLUMNS = ["value", "user_id"]


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


def r6(c, digits: int = 6):
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def _rounded(df: DataFrame, cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# ---------------------------------------------------------------- shared plans

def split_tagged(spark: SparkSession, sf: str) -> DataFrame:
    return model_rows(spark, sf).withColumn("split", sample.split_column("id", TEST_SIZE, SPLIT_SEED))


def fitted_prep(spark: SparkSession, sf: str, numeric_strategy: str = "mean"):
    """Preprocessing fitted on the training split only."""
    train_rows, _ = sample.split_hash(model_rows(spark, sf), "id", TEST_SIZE, SPLIT_SEED)
    return features.feature_pipeline(NUMERIC, CATEGORICAL, FEATURES, numeric_strategy).fit(train_rows)


def feature_table(spark: SparkSession, sf: str, carry: tuple[str, ...] = (),
                  only_split: str | None = None, numeric_strategy: str = "mean") -> DataFrame:
    """``id, split, <feature slots>, label`` — preprocessing fitted on train,
    applied to every row (or only to the rows of ``only_split``). ``carry``
    keeps raw columns (as ``raw_<name>``).

    A split filter must be applied before the fitted transform: the vector
    assembler's UDF is non-deterministic to Catalyst, which therefore does
    not push predicates below it.
    """
    prep = fitted_prep(spark, sf, numeric_strategy)
    tagged = split_tagged(spark, sf)
    if only_split is not None:
        tagged = tagged.where(F.col("split") == only_split)
    tagged = tagged.select(*tagged.columns, *[F.col(c).alias(f"raw_{c}") for c in carry])
    out = prep.transform(tagged)
    return features.vector_slots(out, "features", FEATURES,
                                 keep=["id", "split", "label", *[f"raw_{c}" for c in carry]])


def linear_scored(spark: SparkSession, sf: str, carry: tuple[str, ...] = (),
                  only_split: str | None = None) -> DataFrame:
    ft = feature_table(spark, sf, carry, only_split)
    return score.score_linear(ft, LINEAR_COEFFICIENTS, LINEAR_INTERCEPT,
                              keep=("split", "label", *[f"raw_{c}" for c in carry]))


def test_scored(spark: SparkSession, sf: str, carry: tuple[str, ...] = ()) -> DataFrame:
    return linear_scored(spark, sf, carry, only_split="test")


def scorer_grid(spark: SparkSession, sf: str) -> DataFrame:
    """``(scorer, seq, id, label, prediction)`` for a list of deterministic
    scorers over the test rows: one scan, each row exploded into one entry per
    scorer and folded straight into the per-scorer confusion counts."""
    t = test_scored(spark, sf, carry=("priority",)).withColumnRenamed("raw_priority", "priority")
    entries = [("linear", F.col("prediction"))]
    entries += [(f"mod_{k}", (F.pmod("id", F.lit(k)) == 0).cast("double")) for k in RUN_MODS]
    entries += [("constant_0", F.lit(0.0)), ("constant_1", F.lit(1.0)),
                ("alternating", F.pmod("id", F.lit(2)).cast("double")),
                ("urgent_rule", (F.col("priority") == "1-URGENT").cast("double"))]
    arr = F.array(*[F.struct(F.lit(n).alias("scorer"), F.lit(i).cast("long").alias("seq"),
                             p.cast("double").alias("prediction")) for i, (n, p) in enumerate(entries)])
    return t.select("id", "label", F.explode(arr).alias("s")).select(
        "s.scorer", "s.seq", "id", "label", "s.prediction")


def scorer_metrics(spark: SparkSession, sf: str) -> DataFrame:
    g = scorer_grid(spark, sf)
    cm = metrics.confusion_matrix(g, by=("scorer", "seq"))
    return metrics.metrics_from_confusion(cm, by=("scorer", "seq"))


def runs_table(spark: SparkSession, sf: str) -> DataFrame:
    """Scorer evaluations as run rows (``registry.RUN_SCHEMA``)."""
    m = scorer_metrics(spark, sf)
    exp = F.lit(EXPERIMENT)
    return m.select(
        registry.run_id(exp, F.col("scorer")).alias("run_id"),
        registry.run_id(exp, F.lit("parent")).alias("parent_run_id"),
        exp.alias("experiment"), F.col("scorer").alias("name"),
        F.create_map(F.lit("scorer"), F.col("scorer")).alias("params"),
        F.create_map(F.lit("f1"), F.col("f1"), F.lit("accuracy"), F.col("accuracy")).alias("metrics"),
        F.col("seq"), F.lit(None).cast("string").alias("model_path"))


def drift_long(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Baseline and current sides of every drift pair as ``(feature, x)``,
    one scan per table and side."""
    return drift_long_sides(spark, sf)


def fitted_classifier(spark: SparkSession, sf: str, algorithm: str = "logreg", **params):
    train_rows, test_rows = sample.split_hash(model_rows(spark, sf), "id", TEST_SIZE, SPLIT_SEED)
    stages = features.prep_stages(NUMERIC, CATEGORICAL, FEATURES)
    model = train.fit_pipeline(stages, algorithm, **params).fit(train_rows)
    return model, train_rows, test_rows


# ---------------------------------------------------------------- 2.1 sources and sinks

@query("scan_parquet")
def q_scan_parquet(spark, sf):
    return model_rows(spark, sf)


@query("write_parquet")
def q_write_parquet(spark, sf):
    path = files.write_parquet(model_rows(spark, sf), scratch_path(spark, "parquet"))
    return files.scan_parquet(spark, path)


@query("scan_csv")
def q_scan_csv(spark, sf):
    path = scratch_path(spark, "csv")
    model_rows(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    schema = T.StructType(RAW_CONTRACT.fields + [T.StructField("label", T.DoubleType())])
    return files.scan_csv(spark, path, schema=schema)


@query("csv_evidence")
def q_csv_evidence(spark, sf):
    """Types of the dirty events, written as CSV, with the counts that they rest on."""
    path = scratch_path(spark, "evidence")
    dirty = dirty_events(spark, sf)
    marked = dirty.withColumns({"day": F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("event_id", F.lit(400)).cast("int")),
                                "even": F.pmod("event_id", F.lit(2)) == 0})
    marked.write.option("header", True).csv(path)
    return inference.csv_evidence(spark, path)


@query("write_csv_predictions")
def q_write_csv_predictions(spark, sf):
    path = files.write_csv_predictions(score.baseline_mod(model_rows(spark, sf), MOD_K),
                                       scratch_path(spark, "predictions"))
    return files.scan_csv(spark, path, schema="id long, prediction int")


@query("write_report_json")
def q_write_report_json(spark, sf):
    report = metrics.classification_metrics(test_scored(spark, sf)).select(
        F.lit("linear").alias("algorithm"), "f1", "accuracy")
    path = files.write_report_json(report, scratch_path(spark, "report"))
    back = spark.read.schema("algorithm string, f1 double, accuracy double").json(path)
    return _rounded(back, ["f1", "accuracy"])


@query("save_model")
def q_save_model(spark, sf):
    model, _, test_rows = fitted_classifier(spark, sf, maxIter=50, regParam=0.01)
    path = files.save_model(model, scratch_path(spark, "model"))
    loaded = files.load_model(path)
    both = score.score_pair(model, loaded, test_rows, names=("p_before", "p_after"))
    # The invariant is the result: every test row scores identically after the round trip.
    return both.select("id", (F.col("p_before") == F.col("p_after")).alias("same"))


# ---------------------------------------------------------------- 2.2 projection, filter, schema

@query("cast_numeric")
def q_cast_numeric(spark, sf):
    ev = clean.cast_numeric(dirty_events(spark, sf), ["value"])
    return ev.select("event_id", F.col("value").alias("value_num"))


@query("rename_label")
def q_rename_label(spark, sf):
    return clean.rename_label(model_rows(spark, sf), "label", "target").select("id", "target")


@query("project")
def q_project(spark, sf):
    return clean.project(model_rows(spark, sf), ["id", "month", "priority", "label"])


@query("filter_split")
def q_filter_split(spark, sf):
    drawn = model_rows(spark, sf).withColumn("_draw", hash_unit("id", SPLIT_SEED))
    return sample.filter_split(drawn, "_draw", TEST_SIZE, "test")


@query("drop_columns")
def q_drop_columns(spark, sf):
    return clean.drop_columns(model_rows(spark, sf), ["age_days", "price", "not_a_column"])


@query("contract_check")
def q_contract_check(spark, sf):
    ev = dirty_events(spark, sf)
    checked = ev.withColumn("errors", clean.contract_errors(ev, EVENTS_CONTRACT))
    return checked.select("event_id", (F.size("errors") == 0).alias("valid"),
                          F.size("errors").alias("n_errors"),
                          F.array_join("errors", "; ").alias("errors"))


# ---------------------------------------------------------------- 2.3 aggregation

@query("agg_mean")
def q_agg_mean(spark, sf):
    return _rounded(agg.agg_mean(model_rows(spark, sf), NUMERIC), NUMERIC)


@query("agg_mode")
def q_agg_mode(spark, sf):
    return agg.agg_mode(model_rows(spark, sf), "status")


@query("agg_median")
def q_agg_median(spark, sf):
    cols = ["price", "age_days"]
    return _rounded(agg.agg_median(model_rows(spark, sf), cols), cols)


@query("count_rows")
def q_count_rows(spark, sf):
    return agg.count_rows(model_rows(spark, sf))


@query("prediction_distribution")
def q_prediction_distribution(spark, sf):
    return agg.prediction_distribution(linear_scored(spark, sf))


@query("positive_rate")
def q_positive_rate(spark, sf):
    return _rounded(agg.positive_rate(linear_scored(spark, sf)), ["positive_rate"])


@query("category_frequency")
def q_category_frequency(spark, sf):
    return agg.category_frequency(model_rows(spark, sf), "status")


# ---------------------------------------------------------------- 2.4 ordering, sampling, splitting

@query("top_1")
def q_top_1(spark, sf):
    return agg.top_1(model_rows(spark, sf), [F.col("price").desc_nulls_last(), F.col("id").asc()])


@query("limit_sample")
def q_limit_sample(spark, sf):
    return sample.limit_sample(model_rows(spark, sf), "id", SAMPLE_SIZE, SAMPLE_SEED)


@query("split_rand")
def q_split_rand(spark, sf):
    # A draw of exact size within each label.
    tr, te = sample.split_random(model_rows(spark, sf), TEST_SIZE, SPLIT_SEED, key="id", by=("label",))
    return (tr.select("id", "label", F.lit("train").alias("split"))
            .unionByName(te.select("id", "label", F.lit("test").alias("split"))))


@query("split_random")
def q_split_random(spark, sf):
    return sample.exact_split_column(model_rows(spark, sf), "id", TEST_SIZE, SPLIT_SEED).select("id", "split")


@query("split_hash")
def q_split_hash(spark, sf):
    return split_tagged(spark, sf).select("id", "split")


@query("kfold_assign")
def q_kfold_assign(spark, sf):
    return sample.kfold_assign(model_rows(spark, sf), "id", train.FOLDS, FOLD_SEED).select("id", "fold")


@query("shuffle_rows")
def q_shuffle_rows(spark, sf):
    return sample.shuffle_rows(model_rows(spark, sf).select("id", "label"), SAMPLE_SEED, key="id")


# ---------------------------------------------------------------- 2.5 imputation and features

@query("impute_mean")
def q_impute_mean(spark, sf):
    out = features.impute(model_rows(spark, sf), NUMERIC, "mean")
    return _rounded(out.select("id", *NUMERIC), NUMERIC)


@query("impute_median")
def q_impute_median(spark, sf):
    out = features.impute(model_rows(spark, sf), NUMERIC, "median")
    return _rounded(out.select("id", *NUMERIC), NUMERIC)


@query("impute_mode")
def q_impute_mode(spark, sf):
    return features.impute(model_rows(spark, sf), CATEGORICAL, "mode").select("id", *CATEGORICAL)


@query("string_index")
def q_string_index(spark, sf):
    out = features.string_index(model_rows(spark, sf), CATEGORICAL)
    return out.select("id", *CATEGORICAL, *INDEXED)


@query("string_index_table")
def q_string_index_table(spark, sf):
    """The customers of all orders indexed through a table; nulls by formula, few values broadcast."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    key = F.when(F.pmod("o_orderkey", F.lit(INDEX_NULL_EVERY)) != 0, F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    rows = orders.select(F.col("o_orderkey").alias("id"), key.alias("customer"))
    return index_table.apply_index(rows, "customer", index_table.index_table(rows, "customer"), heavy=100)


@query("one_hot")
def q_one_hot(spark, sf):
    out = features.one_hot(model_rows(spark, sf), CATEGORICAL)
    cols = []
    for c in CATEGORICAL:
        size = out.schema[f"{c}_index_vec"].metadata["ml_attr"]["num_attrs"]
        arr = vector_to_array(F.col(f"{c}_index_vec"))
        cols += [arr[i].alias(f"{c}_{i}") for i in range(size)]
    return out.select("id", *cols)


@query("assemble_features")
def q_assemble_features(spark, sf):
    filled = features.impute(features.impute(model_rows(spark, sf), NUMERIC, "mean"), CATEGORICAL, "mode")
    out = features.assemble_features(features.string_index(filled, CATEGORICAL), FEATURES)
    return _rounded(features.vector_slots(out, "features", FEATURES, keep=["id"]), FEATURES)


@query("feature_table")
def q_feature_table(spark, sf):
    return _rounded(feature_table(spark, sf), FEATURES)


@query("feature_table_median")
def q_feature_table_median(spark, sf):
    """The declared median strategy: sketch in the stats scan, one exact pass."""
    return _rounded(feature_table(spark, sf, numeric_strategy="median"), FEATURES)


# ---------------------------------------------------------------- 2.6 training and selection

@query("train_logreg")
def q_train_logreg(spark, sf):
    model, _, _ = fitted_classifier(spark, sf, "logreg", maxIter=50, regParam=0.01)
    coef, intercept = score.linear_parameters(model.stages[-1], FEATURES)
    rows = [("intercept", intercept)] + list(coef.items())
    return _rounded(spark.createDataFrame(rows, "term string, coefficient double"), ["coefficient"], 8)


@query("train_random_forest")
def q_train_random_forest(spark, sf):
    """A forest and its node table, walked level by level: every test row gets the probability that the forest gives."""
    depth = 5
    model, _, test_rows = fitted_classifier(spark, sf, "random_forest", numTrees=10, maxDepth=depth)
    scored = model.transform(test_rows).select(
        "id", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p"))
    walked = forest.score_nodes(scored, forest.forest_nodes(spark, model), depth)
    both = scored.select("id", "p").join(walked, "id", "full")
    return both.select("id", F.coalesce(F.abs(F.col("p") - F.col("probability")) < 1e-12, F.lit(False)).alias("same"))


@query("forest_importance")
def q_forest_importance(spark, sf):
    model, _, _ = fitted_classifier(spark, sf, "random_forest", numTrees=10, maxDepth=5)
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(FEATURES, imp)), "feature string, importance double")


def _prepared(spark, sf):
    train_rows, test_rows = sample.split_hash(model_rows(spark, sf), "id", TEST_SIZE, SPLIT_SEED)
    prep = features.feature_pipeline(NUMERIC, CATEGORICAL, FEATURES)
    prep_model, prepared = train.prepare(prep, train_rows)
    return prep_model, prepared, test_rows


@query("cross_validate")
def q_cross_validate(spark, sf):
    prep_model, prepared, test_rows = _prepared(spark, sf)
    try:
        found = train.cross_validate(prepared, "logreg", SEARCH_GRIDS["logreg"])
    finally:
        prepared.unpersist()
    best = train.PipelineModel(stages=list(prep_model.stages) + [found.fit_best()])
    return score.score_batch(best, test_rows, keep=("label",))


@query("cv_trials")
def q_cv_trials(spark, sf):
    _, prepared, _ = _prepared(spark, sf)
    try:
        trials, _ = train.search(prepared, SEARCH_GRIDS)
        return trials  # one row per grid point, built from the fitted models' metrics
    finally:
        prepared.unpersist()


@query("select_best_model")
def q_select_best_model(spark, sf):
    train_rows, test_rows = sample.split_hash(model_rows(spark, sf), "id", TEST_SIZE, SPLIT_SEED)
    prep = features.feature_pipeline(NUMERIC, CATEGORICAL, FEATURES)
    _, summary = train.select_best_model(prep, train_rows, test_rows, SEARCH_GRIDS)
    return summary


@query("train_single")
def q_train_single(spark, sf):
    train_rows, test_rows = sample.split_hash(model_rows(spark, sf), "id", TEST_SIZE, SPLIT_SEED)
    stages = features.prep_stages(NUMERIC, CATEGORICAL, FEATURES)
    _, report = train.train_single(stages, train_rows, test_rows, "logreg", maxIter=50, regParam=0.1)
    return _rounded(report, ["f1", "accuracy"])


# ---------------------------------------------------------------- 2.7 evaluation

@query("confusion_matrix")
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(test_scored(spark, sf))


@query("accuracy")
def q_accuracy(spark, sf):
    return _rounded(metrics.accuracy(test_scored(spark, sf)), ["accuracy"])


@query("weighted_f1")
def q_weighted_f1(spark, sf):
    return _rounded(metrics.weighted_f1(test_scored(spark, sf)), ["f1"])


@query("degenerate_check")
def q_degenerate_check(spark, sf):
    g = scorer_grid(spark, sf)
    n = F.count_distinct("prediction")
    return g.groupBy("scorer").agg(n.alias("n_predicted_classes"), (n == 1).alias("degenerate"))


@query("sanity_flags")
def q_sanity_flags(spark, sf):
    t = test_scored(spark, sf)
    # Three scorers over the same rows in one pass: one (scorer, prediction) entry each.
    entries = F.array(*[F.struct(F.lit(n).alias("scorer"), p.alias("prediction")) for n, p in (
        ("linear", F.col("prediction")), ("label_copy", F.col("label")), ("label_flip", F.lit(1.0) - F.col("label")))])
    scored = t.select("label", F.explode(entries).alias("s")).select("s.scorer", "label", "s.prediction")
    m = metrics.metrics_from_confusion(metrics.confusion_matrix(scored, by=("scorer",)), by=("scorer",))
    return _rounded(metrics.sanity_flags(m).select("scorer", "accuracy", "sanity"), ["accuracy"])


@query("evaluate_model")
def q_evaluate_model(spark, sf):
    model, _, test_rows = fitted_classifier(spark, sf, maxIter=50, regParam=0.01)
    loaded = files.load_model(files.save_model(model, scratch_path(spark, "model")))
    return _rounded(metrics.evaluate_model(loaded, test_rows, "logreg"), ["f1", "accuracy"])


# ---------------------------------------------------------------- 2.8 scoring

@query("score_batch")
def q_score_batch(spark, sf):
    model, _, _ = fitted_classifier(spark, sf, maxIter=50, regParam=0.01)
    return _rounded(score.score_batch(model, model_rows(spark, sf, with_label=False)), ["probability"])


@query("score_linear")
def q_score_linear(spark, sf):
    return _rounded(linear_scored(spark, sf).select("id", "probability", "prediction"), ["probability"])


@query("score_stream")
def q_score_stream(spark, sf):
    model, _, _ = fitted_classifier(spark, sf, maxIter=50, regParam=0.01)
    source = files.write_parquet(model_rows(spark, sf, with_label=False), scratch_path(spark, "stream-in"))
    sink, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    raw_schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in RAW_CONTRACT.fields])
    q = score_stream(spark, model, source, raw_schema, sink, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return _rounded(spark.read.parquet(sink), ["probability"])


@query("score_requests")
def q_score_requests(spark, sf):
    model, _, _ = fitted_classifier(spark, sf, maxIter=50, regParam=0.01)
    source = scratch_path(spark, "requests-in")
    request_rows(spark, sf).write.mode("overwrite").json(source)
    sink, ckpt = scratch_path(spark, "requests-out"), scratch_path(spark, "requests-ckpt")
    q = score_requests(spark, model, source, RAW_CONTRACT, sink, ckpt)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return _rounded(spark.read.parquet(sink), ["probability"])


def _finished(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


@query("score_production")
def q_score_production(spark, sf):
    """Every order as a request. Even ids come first, then another version is promoted and the odd ones come,
    with a part of the even ones sent again: those keep their first score."""
    names = ["sink", "ckpt", "in", "runs", "versions"]
    sink, ckpt, source, runs, versions = (scratch_path(spark, f"serve-{n}") for n in names)
    rows = model_rows(spark, sf, with_label=False)
    sent = rows.withColumn("sent_at", F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod("id", F.lit(3600))))
    again = F.pmod("id", F.lit(RESENT_EVERY)) == 0
    even = F.pmod("id", F.lit(2)) == 0
    later = sent.withColumn("sent_at", F.col("sent_at") + F.expr("INTERVAL 30 MINUTES"))
    waves = [sent.where(even), sent.where(~even).unionByName(later.where(even & again))]
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in sent.schema.fields])
    for i, (reg, wave) in enumerate(zip(SERVED_REG, waves)):
        model, _, _ = fitted_classifier(spark, sf, maxIter=50, regParam=reg)
        path = files.save_model(model, scratch_path(spark, "serve-model"))
        run = f"{EXPERIMENT}-{i}"
        registry.run_log(spark.createDataFrame(
            [(run, None, EXPERIMENT, run, {"regParam": str(reg)}, {}, i, path)], registry.RUN_SCHEMA), runs)
        registry.promote(spark, versions, MODEL_NAME, run)
        wave.write.mode("append").parquet(source)
        _finished(serve_production(spark, versions, runs, MODEL_NAME, source, schema, sink, ckpt, delay="2 hours"))
    return _rounded(spark.read.parquet(sink).select("id", "version", "prediction", "probability"), ["probability"])


@query("baseline_mod")
def q_baseline_mod(spark, sf):
    return score.baseline_mod(model_rows(spark, sf), MOD_K)


@query("baseline_alternating")
def q_baseline_alternating(spark, sf):
    return score.baseline_alternating(model_rows(spark, sf))


@query("baseline_constant")
def q_baseline_constant(spark, sf):
    return score.baseline_constant(model_rows(spark, sf))


@query("prediction_summary")
def q_prediction_summary(spark, sf):
    return _rounded(score.prediction_summary(linear_scored(spark, sf), "linear"), ["positive_rate"])


# ---------------------------------------------------------------- 2.9 drift

@query("vector_slot")
def q_vector_slot(spark, sf):
    prep = fitted_prep(spark, sf)
    out = prep.transform(model_rows(spark, sf))
    i = FEATURES.index("price")
    return out.select("id", r6(vector_to_array(F.col("features"))[i]).alias("x"))


@query("quantile_edges")
def q_quantile_edges(spark, sf):
    base, _ = drift_long(spark, sf)
    edges = drift.quantile_edges(base)
    return edges.select("feature", F.posexplode("edges").alias("edge_index", "edge")).select(
        "feature", "edge_index", r6("edge").alias("edge"))


@query("bucketize")
def q_bucketize(spark, sf):
    base, cur = drift_long(spark, sf)
    return drift.bin_counts(cur, drift.edge_lists(base), "n")


@query("bin_shares")
def q_bin_shares(spark, sf):
    base, cur = drift_long(spark, sf)
    edges = drift.edge_lists(base)
    b = drift.bin_shares(base, edges).withColumn("side", F.lit("baseline"))
    c = drift.bin_shares(cur, edges).withColumn("side", F.lit("current"))
    return _rounded(b.unionByName(c), ["share"], 8)


@query("psi")
def q_psi(spark, sf):
    base, cur = drift_long(spark, sf)
    return _rounded(drift.psi_long(base, cur).select("feature", "psi"), ["psi"], 8)


@query("drift_report")
def q_drift_report(spark, sf):
    base, cur = drift_long(spark, sf)
    rep = drift.drift_report_long(base, cur)
    return _rounded(_rounded(rep, ["psi"], 8), ["null_share_baseline", "null_share_current"])


@query("feature_drift")
def q_feature_drift(spark, sf):
    """Drift of the processed feature vectors, training split vs held-out rows,
    over every slot (``posexplode`` of the vector). Each side is filtered
    before the fitted transform."""
    prep = fitted_prep(spark, sf)
    tagged = split_tagged(spark, sf)
    sides = [drift.vector_long(prep.transform(tagged.where(F.col("split") == s)), "features", FEATURES)
             for s in ("train", "test")]
    rep = drift.drift_report_long(*sides)
    return _rounded(_rounded(rep, ["psi"], 8), ["null_share_baseline", "null_share_current"])


@query("drift_summary")
def q_drift_summary(spark, sf):
    base, cur = drift_long(spark, sf)
    return _rounded(drift.drift_summary(drift.drift_report_long(base, cur)), ["max_psi"], 8)


@query("drift_stream")
def q_drift_stream(spark, sf):
    """The events arrive in micro-batches and are compared, by windows of five days, with the stored profile of
    the first ten days."""
    events = spark.read.parquet(f"{sf}/events.parquet").select("ts", *DRIFT_COLUMNS)
    first = events.where(F.col("ts") < F.lit(DRIFT_BASELINE_END).cast("timestamp"))
    names = ["profile", "in", "out", "ckpt"]
    profile, source, sink, ckpt = (scratch_path(spark, f"drift-{n}") for n in names)
    baseline_profile(agg.long_form(first, DRIFT_COLUMNS)).write.parquet(profile)
    events.repartition(4).write.parquet(source)
    _finished(drift_stream(spark, profile, source, events.schema, "ts", DRIFT_COLUMNS, DRIFT_WINDOW, "60 days", sink, ckpt,
                           max_files_per_trigger=2))
    rep = window_drift(spark, sink).withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))
    return _rounded(_rounded(rep, ["psi"], 8), ["null_share"])


# ---------------------------------------------------------------- 2.10 runs, versions, retrain gate

def _flat_runs(runs: DataFrame) -> DataFrame:
    return runs.select("run_id", "parent_run_id", "experiment", "name", "seq",
                       r6(F.col("metrics")["f1"]).alias("f1"),
                       r6(F.col("metrics")["accuracy"]).alias("accuracy"))


@query("run_log")
def q_run_log(spark, sf):
    return _flat_runs(logged_runs(spark, sf))


def logged_runs(spark: SparkSession, sf: str) -> DataFrame:
    """The runs as the registry sees them: evaluated once (one scan of the
    data), appended to a Parquet runs table, read back. Later steps read
    this small table instead of recomputing the evaluations."""
    return registry.run_log(runs_table(spark, sf), scratch_path(spark, "runs"))


@query("best_run")
def q_best_run(spark, sf):
    best = registry.best_run(logged_runs(spark, sf), EXPERIMENT, "f1")
    return _flat_runs(best).select("run_id", "name", "f1")


@query("promote_version")
def q_promote_version(spark, sf):
    runs = logged_runs(spark, sf)
    versions = registry.register_versions(runs, MODEL_NAME)
    best = registry.best_run(runs, EXPERIMENT, "f1")
    path = scratch_path(spark, "versions")
    registry.store_versions(versions, path)
    return registry.promote(spark, path, MODEL_NAME, best)


@query("retrain_gate")
def q_retrain_gate(spark, sf):
    base, cur = drift_long(spark, sf)
    return registry.retrain_decision(drift.drift_report_long(base, cur), enabled=True)


@query("retrain_chain")
def q_retrain_chain(spark, sf):
    """The chain after a retrain decision: every stage runs once; started again it takes what is recorded."""
    root = scratch_path(spark, "retrain")
    prep = features.feature_pipeline(NUMERIC, CATEGORICAL, FEATURES)
    stages = chain.retrain_stages(spark, model_rows(spark, sf), prep, root, MODEL_NAME, EXPERIMENT,
                                  test_size=TEST_SIZE, seed=SPLIT_SEED, maxIter=50, regParam=0.01)
    source = [f"{sf}/orders.parquet"]
    first = chain.retrain(spark, root, stages, source, MODEL_NAME)
    again = chain.retrain(spark, root, stages, source, MODEL_NAME)
    both = first.withColumn("start", F.lit(1)).unionByName(again.withColumn("start", F.lit(2)))
    return _rounded(both, ["f1", "accuracy"])
