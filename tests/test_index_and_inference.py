"""Category indexes as tables against ``StringIndexer``; CSV types with evidence, corrupt records seen."""

import os

from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from keelson.operators.index_table import apply_index, index_table
from keelson.session import scratch_path
from keelson.sources.inference import CORRUPT, csv_evidence, scan_csv_inferred


def test_index_equals_string_indexer_with_a_hot_value_and_a_shuffled_tail(spark):
    n = F.col("id")
    value = F.when(n % 3 == 0, F.lit("hot")).when(n % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("v"), (n % 211).cast("string")))
    rows = spark.range(5000).withColumn("c", value)
    want = StringIndexer(inputCol="c", outputCol="i", handleInvalid="keep").fit(rows).transform(rows)
    want = {r.id: r.i for r in want.collect()}
    index = index_table(rows, "c")
    for heavy in (0, 1, 10, 10_000):
        got = apply_index(rows, "c", index, heavy=heavy)
        assert got.columns == ["id", "c", "c_index"]
        assert {r.id: r.c_index for r in got.collect()} == want
    unseen = spark.createDataFrame([(1, "new"), (2, None), (3, "hot")], "id long, c string")
    assert {r.id: r.c_index for r in apply_index(unseen, "c", index, heavy=5).collect()} == {1: 212.0, 2: 212.0, 3: 0.0}


def test_index_of_many_values_plans_without_a_window_or_a_whole_collect(spark):
    rows = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_003).alias("c"))
    index = index_table(rows, "c")
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert index.agg(F.count("*"), F.countDistinct("index"), F.min("index"), F.max("index")).first()[:] == (1_000_000, 1_000_000, 0, 999_999)


def test_index_of_an_empty_or_null_column_and_a_long_value(spark):
    rows = spark.createDataFrame([(1, None), (2, None)], "id long, c string")
    index = index_table(rows, "c")
    assert index.count() == 0
    assert [r.c_index for r in apply_index(rows, "c", index).collect()] == [0.0, 0.0]
    long = spark.createDataFrame([(1, "x" * 5000), (2, "x" * 5000), (3, "y")], "id long, c string")
    assert {r.id: r.c_index for r in apply_index(long, "c", index_table(long, "c")).collect()} == {1: 0.0, 2: 0.0, 3: 1.0}


def test_types_with_evidence_and_corrupt_records(spark):
    path = scratch_path(spark, "t-csv")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("a,b,c,d,e,f\n1,1.5,true,2024-02-29,x,\n-2,.5e3,False,2024-01-01,1,\n3,7,TRUE,2024-12-31,,\n4,1,true\n")
    found = {r["column"]: r for r in csv_evidence(spark, path).collect()}
    assert {c: r.inferred for c, r in found.items()} == {
        "a": "long", "b": "double", "c": "boolean", "d": "date", "e": "string", "f": "string"}
    assert (found["e"].n, found["e"].n_long, found["f"].n, found["a"].n_corrupt) == (2, 1, 0, 1)
    rows = scan_csv_inferred(spark, path)
    assert dict(rows.dtypes)["d"] == "date" and dict(rows.dtypes)["b"] == "double"
    got = rows.collect()
    assert [r[CORRUPT] for r in got if r[CORRUPT]] == ["4,1,true"] and len(got) == 4


def test_an_impossible_date_is_text(spark):
    path = scratch_path(spark, "t-csv")
    spark.createDataFrame([("2023-02-29",), ("2023-02-28",)], "d string").write.option("header", True).csv(path)
    r = csv_evidence(spark, path).first()
    assert (r.n_date, r.inferred) == (1, "string")
